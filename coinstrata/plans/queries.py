"""The registered queries, each a function of a pipeline.

Arrays and days are shown as text, so that any engine compares them alike.
"""

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.functions import month_key
from coinstrata.operators import (
    balances,
    clustering,
    distribution,
    false_links,
    flatten,
    history,
    periods,
    spends,
    utxo,
)
from coinstrata.operators.entity_index import EntityIndex
from coinstrata.operators.keyed import KeyedLedger
from coinstrata.operators.utxo_state import UtxoState
from coinstrata.plans import reports
from coinstrata.plans.pipeline import LedgerPipeline, whole_records
from coinstrata.sources.files import fingerprint, move
from coinstrata.schemas import SLIM_TRANSACTION_SCHEMA
from coinstrata.sources.ingest import ingest, ingested, manifest
from coinstrata.sources.json_export import (
    first_part,
    load_blocks,
    load_transactions,
    quarantined,
)
from coinstrata.sources.lookup import lookup, write_lookup
from coinstrata.sources.snapshots import load_snapshot, save_snapshot
from coinstrata.sources.tables import load_results

QUERIES: dict[str, Callable[[LedgerPipeline], DataFrame]] = {}


def query(function: Callable[[LedgerPipeline], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def _text(column: str) -> Column:
    return F.array_join(column, ",")


def _day_as_text(df: DataFrame, column: str = "event_date") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


# --- flattening and unspent outputs -------------------------------------------------


@query
def outputs_flat(p):
    return p.outputs.withColumn("addresses", _text("addresses"))


@query
def inputs_flat(p):
    return p.inputs.withColumn("addresses", _text("addresses"))


@query
def spent_references(p):
    return utxo.spend_references(p.references).distinct()


@query
def utxo_set(p):
    return utxo.compute_utxo_set(p.outputs, p.references).withColumn("addresses", _text("addresses"))


@query
def spent_summary(p):
    return utxo.spent_summary(p.flat_outputs("output_index"), p.utxos)


@query
def utxo_addresses(p):
    return balances.utxo_addresses(p.utxos)


# --- transactions -------------------------------------------------------------------


@query
def input_count_distribution(p):
    return distribution.input_count_distribution(p.transactions)


@query
def input_count_head(p):
    """The first 15 input counts up to 20."""
    counts = distribution.input_count_distribution(p.transactions)
    return counts.filter(F.col("input_count") <= 20).orderBy("input_count").limit(15)


@query
def input_split(p):
    return distribution.input_split(p.transactions)


@query
def data_summary(p):
    return distribution.data_summary(p.transactions, p.blocks)


@query
def block_table(p):
    return p.blocks


@query
def example_multi_input_tx(p):
    return distribution.example_multi_input_tx(p.transactions)


@query
def tx_preview(p):
    return distribution.tx_preview(p.transactions)


# --- clustering ---------------------------------------------------------------------


@query
def clustering_inputs(p):
    sources = p.flat_outputs("tx_hash", "output_index", "addresses")
    return clustering.enrich_clustering_inputs(p.records, sources)


@query
def tx_address_sets(p):
    return clustering.tx_address_sets(p.clustering_inputs, p.folder)


@query
def co_input_edges(p):
    return p.edges


@query
def graph_vertices(p):
    return clustering.graph_vertices(p.edges)


@query
def entities(p):
    return p.entities


@query
def entities_with_singletons(p):
    """Every address that inputs or outputs name first, alone or clustered."""
    paid = p.flat_outputs("addresses").select(F.get("addresses", F.lit(0)).alias("address"))
    return clustering.with_singletons(p.entities, paid)


@query
def clustering_summary(p):
    return clustering.clustering_summary(p.entities)


@query
def entity_sizes(p):
    return clustering.entity_sizes(p.entities)


@query
def top_entities_by_size(p):
    return clustering.top_entities_by_size(clustering.entity_sizes(p.entities))


@query
def entity_size_histogram(p):
    return balances.equal_width_histogram(clustering.entity_sizes(p.entities), "address_count")


# --- balances -----------------------------------------------------------------------


@query
def entity_balances(p):
    return balances.entity_balances(p.utxos, p.entities)


@query
def balance_totals(p):
    return balances.balance_totals(p.entity_balances)


@query
def top_whales(p):
    return balances.top_holders(p.entity_balances, 20)


@query
def top_whale_share(p):
    """What the 10 and the 20 largest hold."""
    return balances.top_holder_share(p.entity_balances, 10).unionByName(
        balances.top_holder_share(p.entity_balances, 20)
    )


@query
def largest_entity(p):
    return balances.largest_entity(p.entity_balances)


@query
def whale_categories(p):
    return balances.category_statistics(p.entity_balances)


@query
def whale_concentration(p):
    return balances.mega_holder_concentration(p.entity_balances)


@query
def largest_entity_members(p):
    return balances.entity_addresses(p.entities, balances.largest_entity(p.entity_balances))


@query
def whale_addresses(p):
    return balances.holder_addresses(
        p.utxos, p.entities, balances.largest_entity(p.entity_balances)
    )


@query
def top_whale_addresses(p):
    return balances.top_addresses(whale_addresses(p), 10)


@query
def balance_statistics(p):
    return balances.balance_statistics(p.entity_balances, p.folder)


@query
def balance_histogram(p):
    return balances.equal_width_histogram(p.entity_balances, "balance_satoshi")


# --- time series --------------------------------------------------------------------


@query
def utxo_history(p):
    return history.owned_history(spends.spent_outputs(p.spends), p.utxos, p.entities)


@query
def utxo_history_direct(p):
    """The same from flat outputs and inputs alone, without the shared link."""
    return history.utxo_history(p.outputs, p.inputs, p.entities)


@query
def history_counts(p):
    return history.history_counts(p.history)


@query
def balance_events(p):
    return _day_as_text(p.events)


@query
def event_counts(p):
    return history.event_counts(p.events)


@query
def daily_changes(p):
    return _day_as_text(p.daily)


@query
def entity_timeline(p):
    return _day_as_text(p.timeline)


@query
def timeline_counts(p):
    return history.timeline_counts(p.timeline)


@query
def top_whale_trajectories(p):
    return _day_as_text(history.holder_trajectories(p.daily, p.entity_balances, 5))


@query
def largest_entity_timeline(p):
    """The first ten days of the largest entity."""
    days = history.holder_days(p.daily, p.entity_balances, 1)
    first = history.balance_timeline(days).orderBy("event_date").limit(10)
    return _day_as_text(first.select("event_date", "daily_delta", "cumulative_btc"))


@query
def category_by_month(p):
    return history.category_by_month(p.timeline, p.entity_balances)


@query
def category_by_month_head(p):
    """The first ten rows by month and category."""
    return category_by_month(p).orderBy("year_month", "category").limit(10)


@query
def category_month_end(p):
    return history.category_month_end(p.daily, p.entity_balances)


@query
def whale_monthly_flow(p):
    return history.holder_monthly_flow(p.daily, p.entity_balances)


@query
def whale_recent_flow(p):
    """The last twelve active months."""
    return whale_monthly_flow(p).orderBy(F.desc("year_month")).limit(12)


@query
def whale_trend(p):
    return history.holder_trend(history.holder_monthly_flow(p.daily, p.entity_balances))


# --- reports ------------------------------------------------------------------------


@query
def global_counts(p):
    return reports.global_counts(p)


@query
def executive_report(p):
    return reports.executive_report(p)


@query
def key_metrics(p):
    return reports.key_metrics(p)


# --- sources and sinks --------------------------------------------------------------


def _write_export(p: LedgerPipeline, base: str) -> None:
    """The ledger as a JSON export of two batches, one ``date=`` folder per month; each
    table is written in one go, into folders named by batch and kind.

    ``rebalance`` brings a month together so that it gets few files, and splits a month
    that is too large for one task. Its files are compressed, so each is read by one task.
    """
    tables = {"transactions": (p.records, "block_number"), "blocks": (p.blocks, "number")}
    for kind, (table, day) in tables.items():
        month = F.trunc(F.date_from_unix_date(F.col(day).cast("int")), "month")
        early = month < F.lit("1998-01-01").cast("date")
        dated = table.withColumns({"date": month, "batch": F.when(early, "a").otherwise("b")})
        dated = dated.hint("rebalance", "batch", "date")
        writer = dated.write.mode("overwrite").option("compression", "gzip")
        writer.partitionBy("batch", "date").json(f"{base}/{kind}")
        for batch in ("a", "b"):
            move(p.spark, f"{base}/{kind}/batch={batch}", f"{base}/export/batch-{batch}/{kind}")


def _exported(p: LedgerPipeline) -> str:
    base = f"{p.folder}/json"
    p.once("export", lambda: _write_export(p, base))
    return f"{base}/export"


@query
def json_scan(p):
    """Outputs per month of the export, read back with the explicit schema."""
    loaded = load_transactions(p.spark, _exported(p))
    month = month_key(F.date_from_unix_date(F.col("block_number").cast("int")))
    return (
        flatten.explode_outputs(whole_records(loaded, "outputs"))
        .groupBy(month.alias("year_month"))
        .agg(F.count(F.lit(1)).alias("output_rows"), F.sum("value").alias("value"))
    )


@query
def json_scan_pruned(p):
    """Flat outputs of the whole export, read as two date ranges; neither scan opens the
    folders of the other."""
    base = _exported(p)
    early = load_transactions(p.spark, base, end_date="1996-12-31", slim=True)
    late = load_transactions(p.spark, base, start_date="1997-01-01", slim=True)
    both = whole_records(early.unionByName(late), "outputs")
    flat = flatten.explode_outputs(both)
    return flat.withColumn("addresses", _text("addresses"))


@query
def loaded_transactions(p):
    """Transactions of the export with the time of their block."""
    loaded = load_transactions(p.spark, _exported(p), slim=True).filter(first_part())
    return loaded.select(
        "hash",
        "input_count",
        "output_count",
        F.unix_seconds("block_datetime").alias("block_seconds"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
    )


@query
def loaded_blocks(p):
    """Blocks of the export with their time."""
    loaded = load_blocks(p.spark, _exported(p))
    shown = F.unix_seconds("timestamp_dt")
    return loaded.select("number", "transaction_count", shown.alias("block_seconds"))


@query
def json_scan_inferred(p):
    """Transactions and outputs per day of the export, read back without a schema."""
    loaded = load_transactions(p.spark, _exported(p), use_schema=False)
    return loaded.groupBy("block_number").agg(
        F.count(F.when(first_part(), 1)).alias("transactions"),
        F.sum(F.coalesce(F.size("outputs"), F.lit(0))).alias("outputs"),
    )


@query
def json_block_scan(p):
    loaded = load_blocks(p.spark, _exported(p))
    return loaded.select(
        "number", "timestamp", "transaction_count", F.col("date").cast("string").alias("date")
    )


@query
def parquet_roundtrip(p):
    """Unspent outputs written as a result table and read back."""
    p.once("results", lambda: p.save(f"{p.folder}/results"))
    saved = load_results(p.spark, f"{p.folder}/results", "utxos")
    return saved.withColumn("addresses", _text("addresses"))


# --- growing ledgers ----------------------------------------------------------------

#: Last days of the first two of three periods, as block numbers: March 1997, May 1999.
PERIODS = (9951, 10742)


def _in_period(column: Column, number: int) -> Column:
    low, high = [None, *PERIODS][number], [*PERIODS, None][number]
    inside = F.lit(True) if low is None else column > low
    return inside if high is None else inside & (column <= high)


def _entity_index(p: LedgerPipeline) -> EntityIndex:
    """The ledger's periods as three batches."""
    folder = f"{p.folder}/entity-index"

    def build() -> None:
        index = EntityIndex(p.spark, folder)
        day = F.floor(F.col("spent_timestamp") / 86400)
        usable = p.spends.filter(spends.within_input_bounds(p.min_inputs, p.max_inputs))
        for number in range(3):
            index.add(spends.input_addresses(usable.filter(_in_period(day, number))))

    p.once("entity-index", build)
    return EntityIndex(p.spark, folder)


@query
def entities_by_batches(p):
    """Entities after three batches, each added to what the ones before it found."""
    return _entity_index(p).entities()


@query
def entity_merges(p):
    """Which entities the second and third batch joined to others or renamed."""
    return _entity_index(p).merges


def _utxo_state(p: LedgerPipeline) -> tuple[str, str]:
    """Folders of two states: after the second period was applied and undone, and after all
    three, with the second one replaced."""
    early, late = f"{p.folder}/utxo-undone", f"{p.folder}/utxo-replaced"
    ends = [0, *PERIODS, 10**6]

    def apply(state: UtxoState, number: int) -> None:
        inside = _in_period(F.col("block_number"), number)
        state.apply(p.outputs.filter(inside), p.inputs.filter(inside), ends[number] + 1, ends[number + 1])

    def build() -> None:
        state = UtxoState(p.spark, early)
        apply(state, 0)
        apply(state, 1)
        state.undo(ends[1] + 1)
        state = UtxoState(p.spark, late)
        for number in (0, 1):
            apply(state, number)
        state.undo(ends[1] + 1)
        apply(state, 1)
        state.settle(ends[1])
        apply(state, 2)

    p.once("utxo-state", build)
    return early, late


@query
def utxo_after_undo(p):
    """The unspent set of the first period, after the second was applied and undone."""
    state = UtxoState(p.spark, _utxo_state(p)[0])
    return state.unspent().withColumn("addresses", _text("addresses"))


@query
def utxo_after_reorganisation(p):
    """The unspent set of all periods, after the second was undone and applied again."""
    state = UtxoState(p.spark, _utxo_state(p)[1])
    return state.unspent().withColumn("addresses", _text("addresses"))


@query
def spent_by_last_period(p):
    """The outputs of earlier periods that the third one spends."""
    state = UtxoState(p.spark, _utxo_state(p)[1])
    return state.spent_since(PERIODS[1] + 1).select("tx_hash", "output_index", "value")


_keyed: dict[str, KeyedLedger] = {}


def _keyed_ledger(p: LedgerPipeline) -> KeyedLedger:
    if p.folder not in _keyed:
        _keyed[p.folder] = KeyedLedger.write(p.spark, p.records, p.outputs, p.folder)
    return _keyed[p.folder]


@query
def utxo_set_keyed(p):
    """The unspent set from tables in buckets of the key."""
    return _keyed_ledger(p).unspent().withColumn("addresses", _text("addresses"))


@query
def clustering_inputs_keyed(p):
    """Inputs with the addresses that they spend, from tables in buckets of the key."""
    linked = _keyed_ledger(p).spends()
    return spends.input_addresses(linked.filter(spends.within_input_bounds(2, None)))


@query
def utxo_history_keyed(p):
    """The history from tables in buckets of the key."""
    return _keyed_ledger(p).history(p.entities)


def _damage() -> Column:
    """What is done to the line of a small transaction, by its number: 0 to 3 is damage."""
    number = F.pmod(F.substring("hash", 3, 18).cast("long"), F.lit(20))
    return F.when(F.col("input_count") + F.col("output_count") <= 40, number)


def _damaged(p: LedgerPipeline) -> str:
    """An export of the ledger in which some lines are torn, some have a word for a number
    and some no hash."""
    base = f"{p.folder}/damaged"

    def write() -> None:
        whole = F.to_json(F.struct(*SLIM_TRANSACTION_SCHEMA.names))
        records = p.records
        for name in SLIM_TRANSACTION_SCHEMA.names:
            if name not in records.columns:
                records = records.withColumn(name, F.lit(None).cast(SLIM_TRANSACTION_SCHEMA[name].dataType))
        line = (
            F.when(_damage() == 0, F.substr(whole, F.lit(1), F.char_length(whole) - 20))
            .when(_damage() == 1, F.regexp_replace(whole, '"block_number":', '"block_number":"x"+'))
            .when(_damage() == 2, F.regexp_replace(whole, '"hash":"[^"]*",', ""))
            .when(_damage() == 3, F.regexp_replace(whole, '"block_number":[0-9]+', '"block_number":"x"'))
            .otherwise(whole)
        )
        month = F.trunc(F.date_from_unix_date(F.col("block_number").cast("int")), "month")
        lines = records.select(line.alias("value"), month.alias("date"))
        lines = lines.hint("rebalance", "date").write.mode("overwrite").option("compression", "gzip")
        lines.partitionBy("date").text(f"{base}/batch/transactions")

    p.once("damaged", write)
    return base


@query
def loaded_good_lines(p):
    """What is read of an export with bad lines."""
    loaded = load_transactions(p.spark, _damaged(p), slim=True).filter(first_part())
    return loaded.select("hash", "block_number", "input_count", "output_count")


@query
def quarantined_lines(p):
    """Bad lines by the month of their folder and what is wrong with them."""
    bad = quarantined(p.spark, _damaged(p))
    month = F.regexp_extract("file", "date=([0-9]{4}-[0-9]{2})", 1).alias("year_month")
    return bad.groupBy(month, "reason").agg(F.count(F.lit(1)).alias("lines"))


def _ingested(p: LedgerPipeline) -> str:
    """The damaged export as its parts came: the second half of each year late."""
    base, target = f"{p.folder}/arriving", f"{p.folder}/ingested"

    def run() -> None:
        lines = p.spark.read.text(f"{_damaged(p)}/batch/transactions")
        for number, late in enumerate((F.month("date") <= 6, F.month("date") > 6)):
            part = lines.filter(late).hint("rebalance", "date").write.mode("overwrite")
            part = part.option("compression", "gzip").partitionBy("date")
            part.text(f"{base}/batch-{number}/transactions")
            ingest(p.spark, base, target)
            ingest(p.spark, base, target)  # nothing new

    p.once("ingested", run)
    return target


@query
def ingested_transactions(p):
    """What two runs over a growing export with bad lines have read."""
    loaded = ingested(p.spark, _ingested(p)).filter(first_part())
    return loaded.select("hash", "block_number", "input_count", "output_count")


@query
def ingested_folders(p):
    """Months read by each run, from the manifest of the files read."""
    month = F.regexp_extract("path", "date=([0-9]{4}-[0-9]{2})", 1).alias("month")
    files = manifest(p.spark, _ingested(p)).select("run", month).distinct()
    return files.groupBy("run").agg(F.count(F.lit(1)).alias("months"))


def _months_as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM") for c in columns})


@query
def category_intervals(p):
    """While which category held for an entity."""
    found = periods.category_intervals(periods.month_ends(p.daily))
    return _months_as_text(found, "first_month", "until")


@query
def category_month_end_then(p):
    """Balances at the ends of months by the category that held then."""
    return periods.category_month_end_then(periods.month_ends(p.daily))


@query
def timeline_by_periods(p):
    """The timeline of three periods, each from the balances of the one before it."""
    folder = f"{p.folder}/timeline-index"

    def build() -> None:
        index = periods.TimelineIndex(p.spark, folder)
        day = F.unix_date("event_date")
        for number, last in enumerate((*PERIODS, 10**5)):
            index.add(p.daily.filter(_in_period(day, number)), datetime.date(1970, 1, 1) + datetime.timedelta(last))

    p.once("timeline-index", build)
    return _day_as_text(periods.TimelineIndex(p.spark, folder).timeline())


@query
def entity_bridges(p):
    """Inputs without which an entity falls into two parts of two addresses or more."""
    return false_links.bridges(p.clustering_inputs, p.entities, p.folder, 2, p.large_spenders)


@query
def equal_output_transactions(p):
    """Transactions with two outputs or more that are equal down to 0.1 BTC, and two input
    addresses or more."""
    values = p.flat_outputs("tx_hash", "value")
    return false_links.equal_output_transactions(values, p.clustering_inputs, 2, 2, unit=10**7)


@query
def top_whale_members(p):
    """Addresses of the ten largest holders, looked up in a table clustered by entity."""
    path = f"{p.folder}/lookup-entities"
    p.once("lookup", lambda: write_lookup(p.entities, path, "entity_id"))
    members = p.spark.read.schema(p.entities.schema).parquet(path)
    return lookup(members, "entity_id", balances.top_holders(p.entity_balances, 10).select("entity_id"))


@query
def snapshot_results(p):
    """Unspent outputs and entities of the last snapshot: owned value per entity."""
    folder = f"{p.folder}/snapshots"

    def save() -> None:
        save_snapshot(folder, utxos=p.utxos.limit(0), entities=p.entities.limit(0))
        save_snapshot(folder, utxos=p.utxos, entities=p.entities)

    p.once("snapshots", save)
    held = load_snapshot(p.spark, folder, "utxos"), load_snapshot(p.spark, folder, "entities")
    return balances.entity_balances(*held).select("entity_id", "balance_satoshi", "utxo_count")


_pipelines: dict[tuple, LedgerPipeline] = {}


def pipeline_for(spark: SparkSession, sf_dir: str) -> LedgerPipeline:
    """One pipeline per application and state of the input files, so that queries share
    its stages."""
    tables = [f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem", "part")]
    key = (spark.sparkContext.applicationId, fingerprint(spark, tables))
    if key not in _pipelines:
        _pipelines[key] = LedgerPipeline.from_orders(spark, sf_dir)
    return _pipelines[key]


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        return lambda spark, sf_dir: function(pipeline_for(spark, sf_dir))

    return {name: bind(function) for name, function in QUERIES.items()}
