"""One-row reports over a whole pipeline. Every figure is a scalar subquery."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.operators.balances import mega_holder_concentration, top_holder_share
from coinstrata.operators.clustering import clustering_summary


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def global_counts(pipeline) -> DataFrame:
    """One row: sizes of the tables of the pipeline."""
    clustering = clustering_summary(pipeline.entities)
    return pipeline.transactions.agg(F.count(F.lit(1)).alias("transactions")).select(
        "transactions",
        _count(pipeline.blocks).alias("blocks"),
        _count(pipeline.flat_outputs("output_index")).alias("outputs"),
        _count(pipeline.utxos).alias("utxos"),
        _count(pipeline.clustering_inputs).alias("clustering_inputs"),
        _count(pipeline.edges).alias("edges"),
        clustering.select("address_count").scalar().alias("vertices"),
        clustering.select("entity_count").scalar().alias("entities"),
        _count(pipeline.unwritten_history).alias("history_rows"),
    )


def executive_report(pipeline) -> DataFrame:
    """One row: scope of the data, clustering result and concentration of balances."""
    clustering = clustering_summary(pipeline.entities)
    mega = mega_holder_concentration(pipeline.entity_balances)
    top = top_holder_share(pipeline.entity_balances, 20)
    return mega.select(
        _count(pipeline.blocks).alias("blocks"),
        _count(pipeline.transactions).alias("transactions"),
        _count(pipeline.flat_outputs("output_index")).alias("outputs"),
        _count(pipeline.utxos).alias("utxos"),
        clustering.select("address_count").scalar().alias("addresses"),
        clustering.select("entity_count").scalar().alias("entities"),
        clustering.select("reduction_pct").scalar().alias("reduction_pct"),
        "total_btc",
        "mega_count",
        "mega_btc",
        "mega_share_pct",
        top.select("top_btc").scalar().alias("top20_btc"),
        top.select("top_share_pct").scalar().alias("top20_share_pct"),
    )


def key_metrics(pipeline) -> DataFrame:
    """Five headline figures, each relative to the largest."""
    names = ["transactions", "addresses", "entities", "total_btc", "mega_count"]
    clustering = clustering_summary(pipeline.entities)
    mega = mega_holder_concentration(pipeline.entity_balances)
    row = mega.select(
        _count(pipeline.transactions).cast("double").alias("transactions"),
        clustering.select("address_count").scalar().cast("double").alias("addresses"),
        clustering.select("entity_count").scalar().cast("double").alias("entities"),
        "total_btc",
        F.col("mega_count").cast("double").alias("mega_count"),
    )
    largest = F.greatest(*names)
    metrics = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).alias("value"),
            F.try_divide(F.col(name), largest).alias("relative"),
        )
        for name in names
    ]
    return row.select(F.inline(F.array(*metrics)))
