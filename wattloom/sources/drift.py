"""JSON lines and documents whose fields change between loads.

Each line is parsed once, to a VARIANT. Fields that the schema names are taken out with their types; what it does not name, and
values that do not fit their type, stay in ``_rescued`` as JSON, so lines of the old and the new shape are rows of one table. A line
that is no JSON object keeps its text in the corrupt-record column. Nothing of a line is lost but how a number was spelled (``1.50`` is ``1.5``, and
numbers of more than 38 digits are doubles); a declared FLOAT rounds, as it does without drift.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.timebucket import interval_15m
from wattloom.operators.quality import CORRUPT
from wattloom.sources.readings import POWER_LOG, Paths, _with_load

RESCUED = "_rescued"
# The battery log's fields, and the fields of one battery in it and of one appliance in a document.
BATTERY_LINE = "time_stamp TIMESTAMP, batteries MAP<STRING, VARIANT>"
BATTERY = "capacity_kwh FLOAT, max_charge_speed_w FLOAT, current_energy_wh FLOAT, is_charging INT, status STRING, max_output_w FLOAT"
APPLIANCE = "consumption ARRAY<DOUBLE>, time STRING"

_FIELDS = "_fields"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _as(value: Column, kind: T.DataType | str) -> Column:
    return F.try_variant_get(value, "$", kind if isinstance(kind, str) else kind.simpleString())


def _object(value: Column) -> Column:
    return _as(value, "map<string,variant>")


def _empty(value: Column) -> Column:
    return value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False))


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a value that is there becomes ``kind`` without losing a part: no fraction for whole numbers, each element for arrays and maps."""
    got = _as(value, kind).isNotNull()
    if isinstance(kind, _WHOLE):
        return got & F.coalesce(_as(value, "decimal(38,18)") == _as(value, kind), F.lit(False))
    if isinstance(kind, T.StructType):
        raise ValueError("declare a nested object as MAP<STRING, VARIANT> and take its fields out with typed()")
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else None
    if inner is None or isinstance(inner, T.VariantType):
        return got
    parts = _as(value, "array<variant>") if isinstance(kind, T.ArrayType) else F.map_values(_object(value))
    return got & F.coalesce(F.forall(parts, lambda x: _empty(x) | _fits(x, inner)), F.lit(False))


def typed(rows: DataFrame, doc: str, schema: str | T.StructType, rescued: str = RESCUED) -> DataFrame:
    """``rows`` with the fields of the VARIANT column ``doc`` in its place, and in ``rescued`` what does not fit, NULL if all does.

    A missing field and a JSON null are NULL. A ``doc`` that is no object is rescued whole. A field of the schema takes the place of a
    column of that name.
    """
    fields = _schema(schema).fields
    keep = [c for c in rows.columns if c not in {doc, rescued, *(f.name for f in fields)}]

    def left_over(key: Column, value: Column) -> Column:
        out = F.lit(True)
        for f in fields:
            out = F.when(key == f.name, ~(_empty(value) | _fits(value, f.dataType))).otherwise(out)
        return out

    opened = rows.withColumn(_FIELDS, _object(F.col(doc)))
    spare = F.map_filter(_FIELDS, left_over)
    whole = F.when(F.col(_FIELDS).isNull() & ~_empty(F.col(doc)), F.to_json(F.col(doc)))
    value = lambda f: F.element_at(F.col(_FIELDS), f.name)
    taken = (F.when(_fits(value(f), f.dataType), _as(value(f), f.dataType)).alias(f.name) for f in fields)
    return opened.select(*keep, *taken, F.coalesce(F.when(F.size(spare) > 0, F.to_json(spare)), whole).alias(rescued))


def parse_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """``doc`` (VARIANT) in place of ``text``. Lines that are no object, or name a field twice, have none and keep their text in the
    corrupt-record column; blank lines hold nothing and are left out."""
    parsed = lines.filter(F.trim(text) != "").withColumn("doc", F.try_parse_json(text))
    torn = F.when(_object(F.col("doc")).isNull(), F.col(text))
    rest = [c for c in lines.columns if c not in {text, "doc", CORRUPT}]
    return parsed.withColumn(CORRUPT, torn).select(*rest, F.when(F.col(CORRUPT).isNull(), F.col("doc")).alias("doc"), CORRUPT)


def _lines(spark: SparkSession, path: Paths, origin: str | None) -> DataFrame:
    return parse_lines(_with_load(spark.read.text(path), origin))


def read_power_log(spark: SparkSession, path: Paths, schema: str = POWER_LOG, origin: str | None = None) -> DataFrame:
    """Home or solar log with ``_rescued`` and the corrupt-record column."""
    return typed(_lines(spark, path, origin), "doc", schema).withColumn("interval_15m", interval_15m(F.col("time_stamp")))


def read_battery_log(spark: SparkSession, path: Paths, origin: str | None = None) -> DataFrame:
    """A row per battery with ``_rescued`` of the battery and ``_rescued_line`` of its line.

    A line without batteries, with batteries that are no object, or torn, is one row without a battery.
    """
    line = f"{RESCUED}_line"
    rows = typed(_lines(spark, path, origin), "doc", BATTERY_LINE, line)
    rest = [c for c in rows.columns if c != "batteries"]
    spread = rows.select(*rest, F.explode_outer("batteries").alias("battery_name", "doc"))
    return typed(spread, "doc", BATTERY).withColumn("interval_15m", interval_15m(F.col("time_stamp")))


def read_appliances(documents: DataFrame, home_key: int | str = 1) -> DataFrame:
    """Rows of appliance documents (column ``value``), numbered by name from 1, as a VARIANT's fields are ordered by name; a document that is no object is one row with its text."""
    home = F.col(home_key) if isinstance(home_key, str) else F.lit(home_key)
    parsed = parse_lines(documents.select(home.alias("home_key"), "value"))
    entries = F.array_sort(F.map_keys(_object(F.col("doc"))))
    spread = parsed.select("home_key", CORRUPT, _object(F.col("doc")).alias("all"), F.posexplode_outer(entries).alias("pos", "appliance"))
    rows = typed(spread.withColumn("doc", F.element_at("all", F.col("appliance"))).drop("all"), "doc", APPLIANCE)
    rating = F.col("consumption")
    return rows.select(
        (F.col("pos") + 1).alias("home_appliance_key"), "home_key", "appliance",
        F.get(rating, F.lit(0)).alias("min_consumption_power_wh"), F.get(rating, F.lit(1)).alias("max_consumption_power_wh"),
        F.col("time").alias("usage_time"), RESCUED, CORRUPT,
    )


def kind_of(value: Column) -> Column:
    """JSON kind of a VARIANT: NUMBER, STRING, BOOLEAN, OBJECT, ARRAY or NULL."""
    name = F.regexp_extract(F.schema_of_variant(value), "^([A-Z]+)", 1)
    return F.when(F.is_variant_null(value), "NULL").when(name.isin("BIGINT", "DECIMAL", "DOUBLE"), "NUMBER").otherwise(name)


def drift_report(rows: DataFrame, schema: str | T.StructType, load: str = "load", doc: str = "doc") -> DataFrame:
    """What each load brought, by field and JSON kind: ``load``, ``field``, ``kind``, ``n``, ``unfit`` (values kept in ``_rescued``),
    ``status`` (``new``: not in the schema; ``changed``: some values do not fit; ``known``) and ``first_load``, the first by name with this field and kind.

    ``rows`` is what :func:`parse_lines` returns. Counted before the shuffle, so a load with most lines is a few rows by then.
    """
    fields = _schema(schema).fields
    seen = rows.select(F.col(load).alias("load"), F.explode(_object(F.col(doc))).alias("field", "value"))
    bad = F.lit(True)
    for f in fields:
        bad = F.when(F.col("field") == f.name, ~(_empty(F.col("value")) | _fits(F.col("value"), f.dataType))).otherwise(bad)
    counted = seen.select("load", "field", kind_of(F.col("value")).alias("kind"), bad.alias("bad")).groupBy("load", "field", "kind").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("unfit"))
    status = F.when(~F.col("field").isin([f.name for f in fields]), "new").when(F.col("unfit") > 0, "changed").otherwise("known")
    first = counted.groupBy("field", "kind").agg(F.min("load").alias("first_load"))
    return counted.withColumn("status", status).join(first, ["field", "kind"]).select("load", "field", "kind", "n", "unfit", "status", "first_load")
