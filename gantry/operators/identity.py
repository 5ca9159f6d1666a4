"""Identity of entities over snapshots: records linked by identifiers and renames, ids that stay, and histories of validity."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.session import scratch
from gantry.sources.partitioned import remove

RECORD = ("ticker", "figi", "cik")


def linked(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and label, the least node of its component; ``edges`` has columns a and b of strings.

    A round takes the least label among a node and its neighbours and then the label of that label, so labels travel twice as far each time. Rounds are written below the
    scratch folder; only the number of labels that have changed comes to the driver.
    """
    spark = edges.sparkSession
    root = f"{scratch(spark)}/linked-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    both = kept(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"), F.lit(True).alias("changed")), "0")
    for k in range(1, rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        least = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        new = least.join(jump, "label", "left").select("node", F.least("label", F.coalesce("_next", "label")).alias("label"), "_old")
        labels = kept(new.select("node", "label", (F.col("label") != F.col("_old")).alias("changed")), str(k))
        remove(spark, f"{root}/{k - 1}")
        if labels.filter("changed").isEmpty():
            remove(spark, f"{root}/edges")
            return labels.select("node", "label")
    raise RuntimeError(f"no fixed point in {rounds} rounds")


def _key(*columns: str) -> Column:
    """Null-safe text of columns, the same for the same values only."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]), {"ignoreNullFields": "false"})


def records(snapshots: DataFrame) -> DataFrame:
    """The different (ticker, figi, cik) with their first and last cut."""
    return snapshots.groupBy(*RECORD).agg(F.min("cut").alias("first_cut"), F.max("cut").alias("last_cut")).withColumn("record", F.concat(F.lit("r"), _key(*RECORD)))


def identifier_links(known: DataFrame) -> DataFrame:
    """Each record to the identifiers it has: its FIGI; its CIK with its ticker, as a CIK has several share classes; without either, its ticker alone."""
    figi = F.when(F.col("figi").isNotNull(), F.concat(F.lit("f"), _key("figi")))
    cik = F.when(F.col("cik").isNotNull(), F.concat(F.lit("k"), _key("cik", "ticker")))
    bare = F.when(F.col("figi").isNull() & F.col("cik").isNull(), F.concat(F.lit("t"), _key("ticker")))
    return known.select(F.col("record").alias("a"), F.explode(F.array_compact(F.array(figi, cik, bare))).alias("b"))


def rename_links(known: DataFrame, renames: DataFrame) -> DataFrame:
    """The last record of the old ticker that began before a rename, to the first of the new ticker that is still there at or after it, unless their CIKs differ."""
    old = renames.join(known.select(F.col("ticker").alias("old_ticker"), F.col("record").alias("a"), F.col("cik").alias("_ca"), "first_cut", "last_cut"), "old_ticker").filter(F.col("first_cut") < F.col("at"))
    old = old.groupBy("old_ticker", "new_ticker", "at").agg(F.max_by(F.struct("a", "_ca"), F.struct("last_cut", "a")).alias("_o"))
    new = known.select(F.col("ticker").alias("new_ticker"), F.col("record").alias("b"), F.col("cik").alias("_cb"), "first_cut", F.col("last_cut").alias("_last"))
    met = old.join(new, "new_ticker").filter(F.col("_last") >= F.col("at")).groupBy("old_ticker", "new_ticker", "at").agg(F.first("_o").alias("_o"), F.min_by(F.struct("b", "_cb"), F.struct("first_cut", "b")).alias("_n"))
    return met.filter(F.coalesce(F.col("_o._ca") == F.col("_n._cb"), F.lit(True))).select("_o.a", "_n.b")


def entities(snapshots: DataFrame, renames: DataFrame | None = None) -> DataFrame:
    """Records with entity_id and confidence (D61). ``snapshots`` has cut, ticker, figi and cik; ``renames`` old_ticker, new_ticker and at.

    An entity is named after its earliest record, so its id stays when cuts are added; where a new record joins two entities, the id of the earlier one stays. Confidence is high with a
    FIGI, medium with a CIK, and else low.
    """
    known = records(snapshots)
    links = identifier_links(known)
    if renames is not None:
        links = links.unionByName(rename_links(known, renames))
    labels = linked(links).filter("node LIKE 'r%'")
    joined = known.join(labels, known["record"] == labels["node"]).drop("node")
    name = F.concat_ws("|", F.col("first_cut").cast("string"), _key(*RECORD))
    ids = joined.groupBy("label").agg(F.min(name).alias("entity_id"), F.bool_or(F.col("figi").isNotNull()).alias("_figi"), F.bool_or(F.col("cik").isNotNull()).alias("_cik"))
    confidence = F.when(F.col("_figi"), "high").when(F.col("_cik"), "medium").otherwise("low")
    return joined.join(ids, "label").select(*RECORD, "first_cut", "last_cut", "entity_id", confidence.alias("confidence"))


def _of_record(df: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    r = other.select(*[F.col(c).alias(f"_{c}") for c in RECORD], *columns)
    return df.join(r, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in RECORD]).drop(*[f"_{c}" for c in RECORD])


def validity(snapshots: DataFrame, known: DataFrame) -> DataFrame:
    """Type-2 history: entity_id, record, valid_from, valid_to (the first cut on which it no longer held, null if it holds in the last one) and cuts.

    Of several records of an entity in one cut the best counts: with a FIGI, with a CIK, then by its values. A stretch ends where the record changes or the entity is missing in a cut.
    """
    cuts = snapshots.select("cut").distinct()
    one = Window.partitionBy(F.lit(0)).orderBy("cut")  # the days on which snapshots were taken: as many as the calendar has
    numbered = cuts.select("cut", F.row_number().over(one).alias("_no"), F.lead("cut").over(one).alias("_next"))
    rows = _of_record(snapshots, known, ["entity_id"])
    best = rows.groupBy("entity_id", "cut").agg(F.min(F.struct(F.col("figi").isNull(), F.col("cik").isNull(), *RECORD)).alias("b")).select("entity_id", "cut", *[f"b.{c}" for c in RECORD])
    best = best.join(numbered, "cut")
    state = Window.partitionBy("entity_id", *RECORD).orderBy("_no")
    islands = best.withColumn("_island", F.col("_no") - F.row_number().over(state))
    return islands.groupBy("entity_id", *RECORD, "_island").agg(F.min("cut").alias("valid_from"), F.max_by("_next", "_no").alias("valid_to"), F.count("*").alias("cuts")).drop("_island")


def entity_status(snapshots: DataFrame, known: DataFrame, requested: DataFrame) -> DataFrame:
    """entity_id, first_seen, last_seen, status and status_confidence.

    Active is who is in the last cut and active there. Where cuts in ``requested`` have no snapshot, the confidence is medium for those in the last cut and low for others, else high.
    """
    rows = _of_record(snapshots, known, ["entity_id"])
    seen = rows.groupBy("entity_id").agg(F.min("cut").alias("first_seen"), F.max("cut").alias("last_seen"), F.max_by("active", F.struct("cut", "active")).alias("_active"))
    cuts = snapshots.select("cut").distinct()
    facts = cuts.agg(F.max("cut").alias("_last")).crossJoin(requested.join(cuts, "cut", "left_anti").agg((F.count("*") > 0).alias("_gaps")))
    out = seen.crossJoin(F.broadcast(facts))
    here = F.col("last_seen") == F.col("_last")
    status = F.when(here & F.coalesce("_active", F.lit(False)), "active").otherwise("inactive")
    return out.select("entity_id", "first_seen", "last_seen", status.alias("status"), F.when(~F.col("_gaps"), "high").when(here, "medium").otherwise("low").alias("status_confidence"))


def renamed_entities(before: DataFrame, after: DataFrame) -> DataFrame:
    """Records whose entity has another id in ``after`` (two entities that have become one): record, old_id, new_id."""
    j = _of_record(before.select(*RECORD, F.col("entity_id").alias("old_id")), after, [F.col("entity_id").alias("new_id")])
    return j.filter("old_id <> new_id")
