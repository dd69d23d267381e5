"""A ledger derived from the ``orders`` and ``lineitem`` tables.

One transaction per order, its line items are the outputs, paid to addresses of that
customer; the customer's next order spends most of them. The formulas are those of
FIXTURES.md section 3.

A nested record holds at most ``RECORD_CHUNK`` outputs and inputs. A larger transaction
arrives as several records of the same hash, ``record_part`` 0, 1, ..., with the counts of
the whole transaction on each: flattening and enrichment work row by row and need no
change, and no order can grow one row without bound. ``record_part`` 0 exists for every
transaction, so transaction-level counts read that part only.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinstrata.functions import day_of_epoch
from coinstrata.operators import skew
from coinstrata.operators.skew import hot_groups, numbered, with_neighbours
from coinstrata.sources.tables import write_table

RECORD_CHUNK = 1000

OWN = "struct<ck:bigint,marks:array<tinyint>,amounts:array<bigint>>"
SPENT = "struct<ok:bigint,ck:bigint,marks:array<tinyint>,amounts:array<bigint>>"
FACTS = ["block_timestamp", "input_count", "n", "output_value"]

# The order of a transaction's outputs.
LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_shipdate",
]
# What an output is made of comes from these; line items that agree in them are alike, so
# their order by the rest cannot be seen. The amount stands for the price, which orders items
# in the same way but moves in more bytes.
SHORT_ORDER = [*LINE_ORDER[:3], "amount"]

# An item without an owner, the first mark of an item with two, an owner without a number.
NOBODY, TWO, UNKNOWN = 127, 64, 16


def derive_transactions(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Nested transaction records, see the module text.

    Transactions spend within their customer. Most customers' records come from two shuffles:
    line items by order, to gather them in two arrays of numbers, a mark and an amount of
    each, and orders with these short arrays by customer, where they meet the order before.
    Customers with an order of more than one record, with an order key that is there more
    than once or with more orders than a window should sort go another way.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("ck"), "o_orderdate"
    )
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("ok"), *LINE_ORDER
    )
    odd_keys = write_table(_odd_keys(orders, lines), f"{folder}/odd-keys")
    odd = write_table(_odd_customers(orders, odd_keys), f"{folder}/odd-customers")
    if odd_keys.isEmpty() and odd.isEmpty():
        return _records_by_customer(orders, lines)
    odd_orders = orders.join(odd, "ck", "left_semi").select(orders.columns)
    apart = odd_orders.select("ok").unionByName(odd_keys)
    usual = _records_by_customer(
        orders.join(odd, "ck", "left_anti").select(orders.columns),
        lines.join(apart, "ok", "left_anti").select(lines.columns),
    )
    odd_lines = lines.join(odd_orders.select("ok"), "ok", "left_semi").select(lines.columns)
    return usual.unionByName(_records_by_sides(odd_orders, odd_lines, folder))


def _odd_keys(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order keys that are there more than once or have more line items than a record holds."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    keys = orders.select("ok", one.alias("orders"), none.alias("lines")).unionByName(
        lines.select("ok", none.alias("orders"), one.alias("lines"))
    )
    # Both counts in one number, which is what the shuffle then moves.
    places = F.lit(2**40)
    counts = keys.groupBy("ok").agg(F.sum(F.col("orders") * places + F.col("lines")).alias("n"))
    repeated, large = F.col("n") >= 2 * places, F.col("n") % places > RECORD_CHUNK
    return counts.filter(repeated | large).select("ok")


def _odd_customers(orders: DataFrame, odd_keys: DataFrame) -> DataFrame:
    """Customers whose orders are not for ``_records_by_customer``."""
    found = orders.join(odd_keys, "ok", "left_semi").select("ck")
    found = found.unionByName(orders.filter(F.col("ok").isNull()).select("ck"))
    sizes = orders.groupBy("ck").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > skew.WINDOW_ROWS).select("ck")
    return found.unionByName(large).filter(F.col("ck").isNotNull()).distinct()


def _records_by_customer(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Records of orders of one record each, whose keys are there once."""
    gathered = _gathered_small(lines)
    # Facts are made after the last shuffle, so that only keys, days and arrays move.
    by_day = Window.partitionBy("ck").orderBy("o_orderdate", "ok")
    before = F.lag(F.struct("ok", "marks", "amounts")).over(by_day)
    linked = (
        orders.filter(F.col("ck").isNotNull())
        .join(gathered, "ok", "left")
        .select("ok", "ck", "o_orderdate", "marks", "amounts", before.alias("previous"))
    )
    zero = F.lit(0).cast("long")
    total = F.aggregate("amounts", zero, lambda so_far, x: so_far + F.coalesce(x, zero))

    def count(marks: Column) -> Column:
        return F.when(marks.isNotNull(), F.size(marks)).otherwise(0)

    facts = linked.withColumns(
        {
            "part": zero,
            "n": count(F.col("marks")),
            "output_value": F.coalesce(total, zero) * _scale(F.col("ck")),
            "spent_n": count(F.col("previous.marks")),
        }
    )
    spends = F.when(F.col("previous").isNotNull(), _spends_of("previous.ok", "spent_n")).otherwise(0)
    spent = F.struct("previous.ok", "ck", "previous.marks", "previous.amounts")
    return _as_records(
        facts.select(
            "ok",
            "part",
            F.struct(
                _block_timestamp().alias("block_timestamp"),
                spends.cast("long").alias("input_count"),
                "n",
                "output_value",
            ).alias("tx"),
            F.when(F.col("n") > 0, F.struct("ck", "marks", "amounts")).alias("own"),
            F.when(_any_spent(F.col("previous.ok"), F.col("spent_n")), spent).alias("spent"),
        )
    )


def _records_by_sides(orders: DataFrame, lines: DataFrame, folder: str) -> DataFrame:
    """Records of any orders: both sides of a transaction meet part by part.

    The per-order facts are written below ``folder`` first: they also tell which orders
    exceed one record. Line items are shuffled once, to gather those of an order (part)
    in two arrays of numbers. These short arrays, not the
    outputs and inputs, move when both sides of a transaction meet; texts and nested
    records are made where they are written.
    """
    headers = write_table(_headers(orders, lines, folder), f"{folder}/headers")
    facts = headers.select(
        "ok",
        "ck",
        F.struct(*FACTS).alias("own"),
        F.when(
            F.col("following").isNotNull(),
            F.struct(
                "following.ok",
                F.struct(
                    "following.block_timestamp",
                    _spends_of("ok", "n").alias("input_count"),
                    "following.n",
                    "following.output_value",
                ).alias("tx"),
            ),
        ).alias("spender"),
    )
    gathered = _gathered_lines(lines, headers, folder).join(facts, "ok")
    nothing_own, nothing_spent = F.lit(None).cast(OWN), F.lit(None).cast(SPENT)
    paid = F.struct(
        "ok",
        "part",
        F.col("own").alias("tx"),
        F.struct("ck", "marks", "amounts").alias("own"),
        nothing_spent.alias("spent"),
    )
    spending = F.struct(
        F.col("spender.ok").alias("ok"),
        "part",
        F.col("spender.tx").alias("tx"),
        nothing_own.alias("own"),
        F.struct("ok", "ck", "marks", "amounts").alias("spent"),
    )
    has_inputs = F.col("spender").isNotNull() & _any_spent(F.col("ok"), F.size("marks"))
    sides = gathered.select(
        F.inline(F.when(has_inputs, F.array(paid, spending)).otherwise(F.array(paid)))
    )
    unpaid = headers.filter(F.col("n") == 0).select(
        "ok",
        F.lit(0).cast("long").alias("part"),
        F.struct(*FACTS).alias("tx"),
        nothing_own.alias("own"),
        nothing_spent.alias("spent"),
    )
    # Two sides at most meet in a record, so combining before the shuffle would only cost.
    met = (
        sides.unionByName(unpaid)
        .repartition("ok", "part")
        .groupBy("ok", "part")
        .agg(
            F.first("tx").alias("tx"),
            F.first("own", ignorenulls=True).alias("own"),
            F.first("spent", ignorenulls=True).alias("spent"),
        )
    )
    return _as_records(met)


def _as_records(met: DataFrame) -> DataFrame:
    """Nested records from (ok, part, tx, own, spent)."""
    records = met.select(
        "ok",
        "part",
        "tx",
        F.when(F.col("own").isNotNull(), F.transform("own.amounts", _output_of(F.col("own")))).alias("outputs"),
        F.when(F.col("spent").isNotNull(), _inputs_of(F.col("spent"))).alias("inputs"),
    )
    tx = F.col("tx")
    block_timestamp = tx["block_timestamp"]
    return records.select(
        _hash(F.col("ok")).alias("hash"),
        F.floor(block_timestamp / 86400).cast("long").alias("block_number"),
        block_timestamp.alias("block_timestamp"),
        (tx["input_count"] == 0).alias("is_coinbase"),
        "inputs",
        "outputs",
        tx["input_count"].cast("int").alias("input_count"),
        tx["n"].cast("int").alias("output_count"),
        tx["output_value"].alias("output_value"),
        F.lit(None).cast("long").alias("fee"),
        day_of_epoch(block_timestamp).alias("date"),
        F.col("part").alias("record_part"),
    )


def derive_blocks(transactions: DataFrame) -> DataFrame:
    """One block per distinct block number."""
    return (
        transactions.groupBy("block_number")
        .agg(F.count(F.lit(1)).cast("int").alias("transaction_count"))
        .select(
            F.col("block_number").alias("number"),
            (F.col("block_number") * 86400).alias("timestamp"),
            "transaction_count",
        )
    )


def _headers(orders: DataFrame, lines: DataFrame, folder: str) -> DataFrame:
    """One row per order: its facts, and those of the customer's next order."""
    per_order = lines.groupBy("ok").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_tenth_cents(F.col("l_extendedprice"))).alias("raw_value")
    )
    counted = orders.join(per_order, "ok", "left").select(
        "ok",
        "ck",
        "o_orderdate",
        _block_timestamp().alias("block_timestamp"),
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("raw_value", F.lit(0)) * _scale(F.col("ck"))).alias("output_value"),
    )
    linked = with_neighbours(
        counted,
        key="ck",
        order=["o_orderdate", "ok"],
        carry=["ok", "block_timestamp", "n", "output_value"],
        workdir=folder,
        sizes=orders.groupBy("ck").agg(F.count(F.lit(1)).alias("n")),
    )
    input_count = F.when(
        F.col("previous").isNotNull(), _spends_of("previous.ok", "previous.n")
    ).otherwise(0)
    return linked.select(
        "ok",
        "ck",
        "block_timestamp",
        input_count.alias("input_count"),
        "n",
        "output_value",
        "following",
    )


def _gathered_small(lines: DataFrame) -> DataFrame:
    """(ok, marks, amounts): the line items of an order in output order. A mark tells whom
    the item pays, see ``_mark``."""
    # Line items of an order are few and apart, so combining before the shuffle would only cost.
    return (
        lines.withColumn("amount", _tenth_cents(F.col("l_extendedprice")))
        .select("ok", *SHORT_ORDER)
        .repartition("ok")
        .groupBy("ok")
        .agg(F.sort_array(F.collect_list(F.struct(*SHORT_ORDER))).alias("items"))
        .select("ok", *_marks_and_amounts())
    )


def _gathered_lines(lines: DataFrame, headers: DataFrame, folder: str) -> DataFrame:
    """(ok, part, marks, amounts): as ``_gathered_small``, at most ``RECORD_CHUNK`` items per
    row."""
    large = hot_groups(headers, "ok", RECORD_CHUNK)
    usual = lines if large is None else lines.join(large, "ok", "left_anti")
    gathered = _gathered_small(usual).select(
        "ok", F.lit(0).cast("long").alias("part"), "marks", "amounts"
    )
    if large is None:
        return gathered

    in_order = numbered(
        lines.join(large, "ok", "left_semi"), key="ok", order=LINE_ORDER, workdir=folder, name="idx"
    )
    chunked = (
        in_order.withColumn("amount", _tenth_cents(F.col("l_extendedprice"))).select(
            "ok",
            F.expr(f"idx div {RECORD_CHUNK}").alias("part"),
            F.struct("idx", *SHORT_ORDER).alias("item"),
        )
        .groupBy("ok", "part")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .select("ok", "part", *_marks_and_amounts())
    )
    return gathered.unionByName(chunked)


def _marks_and_amounts() -> list[Column]:
    return [
        F.transform("items", _mark).alias("marks"),
        F.col("items.amount").alias("amounts"),
    ]


def _mark(item: Column) -> Column:
    """``NOBODY``, or the number of the owner's address, with ``TWO`` added if a second
    address is paid."""
    number = F.coalesce(item["l_partkey"] % 16, F.lit(UNKNOWN))
    second = F.when(item["l_linenumber"] == 7, TWO).otherwise(0)
    mark = F.when(item["l_partkey"] % 97 == 0, NOBODY).otherwise(number + second)
    return mark.cast("tinyint")


def _index(position: Column) -> Column:
    """The index in its transaction of the item at ``position`` of a record."""
    return F.col("part") * RECORD_CHUNK + position


def _addresses(mark: Column, customer: Column) -> Column:
    two = mark >= TWO - 15
    number = F.when(two, mark - TWO).otherwise(mark.cast("int"))
    known = F.when(number != UNKNOWN, number.cast("string"))
    own = F.concat(F.lit("c"), customer.cast("string"), F.lit("-"), known)
    shared = F.concat(F.lit("m"), F.shiftright(customer, 1).cast("string"))
    return (
        F.when(mark == NOBODY, F.array().cast("array<string>"))
        .when(two, F.array(own, shared))
        .otherwise(F.array(own))
    )


def _output_of(own: Column) -> Callable[[Column, Column], Column]:
    """Makes the output at a position from its amount."""

    def output(amount: Column, position: Column) -> Column:
        mark = F.get(own["marks"], position)
        return F.struct(
            _index(position).cast("int").alias("index"),
            F.when(mark == NOBODY, "nulldata")
            .when(mark >= TWO - 15, "multisig")
            .otherwise("pubkeyhash")
            .alias("type"),
            _addresses(mark, own["ck"]).alias("addresses"),
            (amount * _scale(own["ck"])).alias("value"),
        )

    return output


def _is_spent(ok: Column, index: Column) -> Column:
    return (ok + index) % 4 != 0


def _any_spent(ok: Column, n: Column) -> Column:
    """Whether any of the n items of a record is spent: of two in a row one is."""
    return (n > 1) | ((n > 0) & _is_spent(ok, _index(F.lit(0))))


def _block_timestamp() -> Column:
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)")
    return seconds + F.col("ok") % 86400


def _inputs_of(spent: Column) -> Column:
    """Inputs from the spent ones of an order's items."""
    ok, ck = spent["ok"], spent["ck"]

    def as_input(amount: Column, position: Column) -> Column:
        idx = _index(position)
        # Every output is spent unless (ok + idx) is divisible by 4, so the unspent ones
        # before it can be counted without a window.
        unspent_before = F.shiftright(ok + idx + 3, 2) - F.shiftright(ok + 3, 2)
        given = F.struct(
            (idx - unspent_before).cast("int").alias("index"),
            _hash(ok).alias("spent_transaction_hash"),
            idx.cast("int").alias("spent_output_index"),
            F.when((ok + idx) % 3 == 0, _addresses(F.get(spent["marks"], position), ck)).alias(
                "addresses"
            ),
            (amount * _scale(ck)).alias("value"),
        )
        return F.when(_is_spent(ok, idx), given)

    return F.filter(F.transform(spent["amounts"], as_input), lambda given: given.isNotNull())


def _hash(order_key: Column) -> Column:
    return F.concat(F.lit("tx"), order_key.cast("string"))


def _tenth_cents(price: Column) -> Column:
    return F.round(price * 10).cast("long")


def _scale(customer: Column) -> Column:
    return F.pow(F.lit(10.0), customer % 5).cast("long")


def _spends_of(order_key: str, outputs: str) -> Column:
    """How many of an order's first n outputs are spent, counted like an input's index."""
    return F.expr(
        f"{outputs} - (({order_key} + {outputs} + 3) div 4 - ({order_key} + 3) div 4)"
    )
