"""Line-protocol text: ``table,tag=v field=1i,other="x" 1700000000000000000``.

Reading and writing are column expressions over Spark's text source, so lines
are parsed where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What the protocol escapes with a backslash.
_TAG = r"([ ,=\n\r\\])"
_FIELD = r"([\"\n\r\\])"
#: A name or tag value: anything but separators, unless escaped.
_PART = r"(?:[^ ,=\\]|\\[\s\S])+"
#: A field value: a quoted string or plain text.
_VALUE = r'(?:"(?:[^"\\]|\\[\s\S])*"|[^ ,"\\]+)'


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _TAG, r"\\$1")


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.regexp_replace(text, _FIELD, r"\\$1"), F.lit('"'))


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def field_text(column: Column, kind: str) -> Column:
    """A value as its field text; NULL is not written."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.concat(column.cast("string"), F.lit("i"))
    if kind == "boolean":
        return F.when(column, "t").otherwise("f")
    if kind.startswith("timestamp"):
        return F.concat(F.unix_micros(column.cast("timestamp")).cast("string"), F.lit("t"))
    if kind.startswith("decimal"):
        return F.concat(column.cast("string"), F.lit("d"))
    return quoted(column) if kind == "string" else column.cast("string")


def to_lines(rows: DataFrame, table: str, symbols: list[str], fields: list[str], nanos: Column | None = None) -> DataFrame:
    """One column ``line``; symbols come first, as the protocol wants."""
    kinds = dict(rows.dtypes)
    tags = [F.when(F.col(s).isNotNull(), F.concat(escaped(F.lit(s)), F.lit("="), escaped(F.col(s)))) for s in symbols]
    values = [F.when(F.col(f).isNotNull(), F.concat(escaped(F.lit(f)), F.lit("="), field_text(F.col(f), kinds[f]))) for f in fields]
    head = F.concat_ws(",", escaped(F.lit(table)), *tags)
    return rows.select(F.concat_ws(" ", head, F.concat_ws(",", *values), *([] if nanos is None else [nanos.cast("string")])).alias("line"))


def parsed(lines: DataFrame) -> DataFrame:
    """table, symbols, fields (maps of text), nanos and, for lines that don't parse, error.

    A line that gives a name twice, whatever its case, or a time beyond 64 bits
    doesn't parse either. Values keep their type mark (``i``, ``t``, ``d``,
    quotes); ``field_as`` reads them. Blank lines are left out.
    """
    whole = rf"^({_PART})((?:,{_PART}={_PART})*) ({_PART}={_VALUE}(?:,{_PART}={_VALUE})*)(?: (-?\d+))?$"
    line = F.regexp_replace("line", r"\r$", "")
    part = lambda i: F.regexp_extract(line, whole, i)

    def pairs(text: Column, value: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(rf"({_PART}={value})"), F.lit(1))
        name = lambda p: F.regexp_extract(p, rf"^({_PART})=", 1)
        return F.transform(found, lambda p: F.struct(_plain(name(p)).alias("name"), F.substring(p, F.length(name(p)) + 2, F.length(p)).alias("text")))

    rows = lines.filter(F.trim("line") != "").select(line.alias("line"), line.rlike(whole).alias("ok"), part(1).alias("head"), pairs(part(2), _PART).alias("tags"), pairs(part(3), _VALUE).alias("values"), part(4).alias("time"))
    names = F.transform(F.concat(F.transform("tags", lambda e: e["name"]), F.transform("values", lambda e: e["name"])), F.lower)
    nanos = F.col("time").try_cast("bigint")
    ok = F.col("ok") & (F.size(F.array_distinct(names)) == F.size(names)) & ((F.col("time") == "") | nanos.isNotNull())

    def as_map(entries: str, plain: bool) -> Column:
        """The first of each name, so that no line can stop the job."""
        known = F.transform(entries, lambda e: e["name"])
        first = F.filter(entries, lambda e, i: F.array_position(known, e["name"]) == i + 1)
        return F.map_from_entries(F.transform(first, lambda e: F.struct(e["name"], _plain(e["text"]) if plain else e["text"])))

    return rows.select(
        F.when(ok, _plain(F.col("head"))).alias("table"),
        F.when(ok, as_map("tags", True)).alias("symbols"),
        F.when(ok, as_map("values", False)).alias("fields"),
        F.when(ok, nanos).alias("nanos"),
        F.when(~ok, F.col("line")).alias("error"),
    )


def field_as(fields: Column, name: str, kind: str) -> Column:
    """A typed field of a parsed line; NULL if it is missing or marked as another type."""
    text = fields[name]
    body = F.regexp_replace(text, "[itd]$", "")
    if kind == "bigint":
        return F.when(text.rlike(r"^-?\d+i$"), body.try_cast("bigint"))
    if kind == "timestamp":
        return F.when(text.rlike(r"^-?\d+t$"), F.timestamp_micros(body.try_cast("bigint")))
    if kind == "boolean":
        return F.when(text.isin("t", "T", "true"), True).when(text.isin("f", "F", "false"), False)
    if kind.startswith("decimal"):
        return F.when(text.endswith("d"), body.try_cast(kind))
    if kind == "string":
        return F.when(text.startswith('"'), _plain(F.substring(text, F.lit(2), F.length(text) - 2)))
    return F.when(text.rlike(r"^-?[0-9.]+(?:[eE][-+]?\d+)?$"), text.try_cast(kind))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return parsed(spark.read.text(path).withColumnRenamed("value", "line"))
