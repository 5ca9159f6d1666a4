"""Small operators: halt notices, tallies, column resolution, row numbers, keys, manifests, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gantry.session import stored

#: Labels of halt codes.
HALT_LABELS = {
    "LUDP": "LULD pause",
    "LUDS": "LULD pause",
    "M": "Volatility pause",
    "T1": "News pending",
    "T2": "News released",
    "T3": "News and resumption pending",
    "T5": "Single-stock trading pause",
    "H4": "Non-compliance",
    "H9": "Not current in filings",
    "D": "Additional information requested",
    "SEC": "SEC suspension",
}


def halt_label(code: Column) -> Column:
    """Label of a halt code, or unknown (SC12)."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in HALT_LABELS.items() for x in pair])[code], F.lit("unknown"))


def halt_notice(df: DataFrame, text: str) -> DataFrame:
    """``df`` with dates, times, market, code and label of a halt's description; what is absent is null (SC11)."""
    s = F.trim(F.regexp_replace(text, r"\s+", " "))
    dates, times = F.regexp_extract_all(s, F.lit(r"\b\d{2}/\d{2}/\d{4}\b"), 0), F.regexp_extract_all(s, F.lit(r"\b\d{2}:\d{2}:\d{2}\b"), 0)
    head = F.trim(F.regexp_replace(s, r"\d{2}/\d{2}/\d{4}.*$", ""))
    part = lambda i: F.regexp_extract(head, r"\b([A-Z]) ([A-Z0-9]+)$", i)
    date = lambda i: F.try_to_date(F.get(dates, i), "MM/dd/yyyy")
    return df.withColumns(
        {"halt_date": date(0), "resume_date": date(1), "halt_time": F.get(times, 0), "quote_time": F.get(times, 1), "trade_time": F.get(times, 2), "market": part(1), "code": part(2), "label": halt_label(part(2))}
    )


def tallies(df: DataFrame) -> DataFrame:
    """A row for each column: rows, nulls, not-a-numbers and finite values (SC38, D100)."""
    number = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    one = lambda c: F.struct(F.lit(c).alias("name"), F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), (F.count_if(F.isnan(c)) if c in number else F.lit(0)).cast("long").alias("nans"), (F.count_if(~F.isnan(c) & (F.abs(c) < float("inf"))) if c in number else F.lit(0)).cast("long").alias("finite"))
    return df.agg(F.array(*[one(c) for c in df.columns]).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def first_of(columns: list[str], names: list[str]) -> str:
    """The first of ``names`` among the columns, whatever their case (PRJ5)."""
    known = {c.lower(): c for c in columns}
    for name in names:
        if name.lower() in known:
            return known[name.lower()]
    raise ValueError(f"none of {names} in {columns}")


def numbered(df: DataFrame, order: list[Column], name: str = "row") -> DataFrame:
    """Row numbers from 0 in a total order, without one task for all rows: a range sort, and counts of the ranges before (PRJ11).

    The sorted ranges are written as a table: their borders come from a sample, so a second range sort for the counts may cut elsewhere.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    table = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")  # number of the range, and of the row within it
    part, within = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = table.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row for each range
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    return table.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(name, within + F.col("_before")).drop("_part", "_before", "_id")


def suffix_join(left: DataFrame, right: DataFrame, keys: list[str], suffix: str = "_right", how: str = "inner") -> DataFrame:
    """A join in which the right side's colliding names get a suffix (JN4)."""
    taken = set(left.columns) - set(keys)
    return left.join(right.withColumnsRenamed({c: c + suffix for c in right.columns if c in taken}), keys, how)


def common_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """A join on the columns that both sides have (JN17)."""
    keys = [c for c in left.columns if c in right.columns]
    if not keys:
        raise ValueError("no common columns")
    return left.join(right, keys, how)


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by the least hash of key and seed: a top-k, no sort of all rows (SO6)."""
    return df.orderBy(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def schemas(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Name, place and type of the columns of files, from their footers (SRC6)."""
    rows = [(t, f.name, i, f.dataType.simpleString()) for t, p in paths.items() for i, f in enumerate(spark.read.parquet(p).schema)]
    return spark.createDataFrame(rows, "t string, name string, place long, type string")


def key_fields(keys: DataFrame) -> DataFrame:
    """dataset, symbol, year, month, day and session of object keys; null where the key has none (SRC11, SRC12)."""
    part = lambda p: F.nullif(F.regexp_extract("key", p, 1), F.lit(""))
    number = lambda p: part(p).try_cast("int")
    return keys.select(
        "key", part(r"^([^/]+)/[^/]+/year=").alias("dataset"), part(r"^[^/]+/([^/]+)/year=").alias("symbol"), number(r"year=(\d{4})/").alias("year"), number(r"month=(\d{2})/").alias("month"),
        F.coalesce(number(r"day=(\d{2})/"), number(r"day=\d{4}-\d{2}-(\d{2})/")).alias("day"), part(r"day=[^/]+/(premarket|rth|postmarket)\.parquet").alias("session"),
    )


def manifest(lines: DataFrame) -> DataFrame:
    """key, raw_size and expected_size of a manifest's object lines, by whichever names they use; headers and footers are left out (SRC8)."""
    m = lines.select(F.from_json("value", "map<string,string>").alias("m")).filter(F.col("m")["type"] == "object")
    raw = F.coalesce(F.col("m")["size"], F.col("m")["Size"], F.col("m")["expected_size_bytes"])
    return m.select(F.coalesce(F.col("m")["key"], F.col("m")["Key"]).alias("key"), raw.alias("raw_size"), raw.try_cast("long").alias("expected_size"))


def inventory(objects: DataFrame, local: DataFrame) -> DataFrame:
    """Each object of a manifest with its status against the files there are: OK, MISSING or SIZE_MISMATCH."""
    j = objects.join(local, "key", "left")
    status = F.when(F.col("local_size").isNull(), "MISSING").when(F.col("expected_size") != F.col("local_size"), "SIZE_MISMATCH").otherwise("OK")
    odd = F.when(F.col("raw_size").isNotNull() & F.col("expected_size").isNull(), "EXPECTED_SIZE_NOT_NUMERIC")
    return j.select("key", "expected_size", "local_size", status.alias("status"), odd.alias("warning"))


def _leaves(schema: StructType, above: str = "") -> list[str]:
    out = []
    for f in schema:
        out += _leaves(f.dataType, f"{above}{f.name}.") if isinstance(f.dataType, StructType) else [above + f.name]
    return out


def flattened(df: DataFrame, json: str, schema: str) -> DataFrame:
    """``df`` with a column for each leaf of a JSON text, named by its dotted path (SRC17)."""
    parsed = df.withColumn(json, F.from_json(json, schema))
    return parsed.select(*[c for c in df.columns if c != json], *[F.col(f"{json}.{p}").alias(p) for p in _leaves(parsed.schema[json].dataType)])


def page_rows(df: DataFrame, page: str, item: str, results: str = "results") -> DataFrame:
    """A row for each item of an API's pages, with its place ``i`` (SRC15)."""
    rows = df.withColumn(page, F.from_json(page, f"{results} array<struct<{item.replace(' ', ':')}>>".replace(",:", ",")))
    keep = [c for c in df.columns if c != page]
    return rows.select(*keep, F.posexplode(F.col(page)[results]).alias("i", "_item")).select(*keep, "i", "_item.*")


def flat_file(raw: DataFrame, names: dict[str, list[str]], allowed: DataFrame) -> DataFrame:
    """Alias columns under their own names, the time from an epoch whose unit the greatest number tells, and only allowed tickers (SRC18)."""
    from gantry.functions import exprs as X

    picked = raw.select(*[F.col(first_of(raw.columns, options)).alias(name) for name, options in names.items()]).withColumn("ticker", F.upper(F.trim("ticker")))
    unit = picked.agg(X.epoch_unit(F.max(F.abs("t"))).alias("_unit"))
    out = picked.join(allowed, "ticker", "left_semi").crossJoin(F.broadcast(unit))
    return out.withColumn("at", X.epoch_to_timestamp(F.col("t"), F.col("_unit")).cast("timestamp_ntz")).drop("t", "_unit")


def ticker_lines(lines: DataFrame) -> DataFrame:
    """Distinct tickers of text lines, upper case; fails if there is none (SRC9)."""
    out = lines.select(F.upper(F.trim("value")).alias("ticker")).filter("ticker <> ''").distinct()
    if out.isEmpty():
        raise ValueError("no tickers")
    return out
