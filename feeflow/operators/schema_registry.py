"""Schema registry: field types over time, and bodies that contradict them.

Every landing is inventoried in full: which fields the bodies of a payload type
have, and of which kinds.  The registry keeps one kind per field, and a landing
moves it along a lattice only upwards:

    null < long < double        null < string | boolean | array | object

A field that was not there is added; a number with a fraction widens a long
field; anything else that does not fit is a conflict, the kind stays, and the
bodies that hold such values go to the quarantine.  A landing that changes the
registry makes a new version of it, published as a release
(:mod:`feeflow.sources.releases`); older versions stay readable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.operators.parse import decode_body
from feeflow.sources.releases import Warehouse

TABLE = "schema_registry"
MAX_FIELDS = 10_000      # registered fields; the registry travels as one literal map
NULL, LONG, DOUBLE = "null", "long", "double"
OTHER_KINDS = ("array", "boolean", "object", "string")
REGISTRY = "payload_type string, field string, kind string, since_version int"


def _fields(text: str) -> Column:
    """Field -> VARIANT of a JSON object; NULL for anything else."""
    return F.from_json(F.col(text), "map<string,variant>")


def _kind(value: Column) -> Column:
    word = F.regexp_extract(F.coalesce(F.schema_of_variant(value), F.lit("VOID")), "^[A-Z]+", 0)
    whole = F.schema_of_variant(value).rlike(r"^(BIGINT|INT|DECIMAL\(\d+,0\))$")
    return (F.when(word == "VOID", NULL).when(word.isin(*[k.upper() for k in OTHER_KINDS]), F.lower(word))
            .when(whole, LONG).otherwise(DOUBLE))


def _payload_type(fields: Column) -> Column:
    """The body's payload type as text; '' where it has none."""
    return F.coalesce(F.try_variant_get(F.try_element_at(fields, F.lit("payload_type")), "$", "string"), F.lit(""))


def field_kinds(messages: DataFrame, text: str = "body_str") -> DataFrame:
    """(payload_type, field, kind, n_messages) over all bodies."""
    if text not in messages.columns:
        messages = decode_body(messages)
    fields = messages.select(_fields(text).alias("m")).where("m IS NOT NULL")
    each = fields.select(_payload_type(F.col("m")).alias("payload_type"), F.explode("m").alias("field", "v"))
    return each.select("payload_type", "field", _kind(F.col("v")).alias("kind")).groupBy(
        "payload_type", "field", "kind").agg(F.count(F.lit(1)).alias("n_messages"))


def _fits(kind: Column, registered: Column) -> Column:
    return (kind == registered) | (kind == NULL) | ((kind == LONG) & (registered == DOUBLE))


def evolve(registry: DataFrame, kinds: DataFrame, version: int) -> DataFrame:
    """The registry after a landing: payload_type, field, kind, since_version,
    change (``added``, ``widened``, ``same`` or ``absent``), n_messages and
    n_conflicts (values of kinds that do not fit)."""
    numeric = F.col("kind").isin(LONG, DOUBLE)

    def count(of: Column) -> Column:
        return F.sum(F.when(of, F.col("n_messages")).otherwise(0))

    families = kinds.groupBy("payload_type", "field").agg(
        count(numeric).alias("numbers"), count(F.col("kind") == DOUBLE).alias("doubles"),
        count(F.col("kind") == NULL).alias("nulls"),
        *[count(F.col("kind") == k).alias(k) for k in OTHER_KINDS], F.sum("n_messages").alias("n_messages"))
    # a field not known yet takes the kind that most of its values have
    most = F.greatest("numbers", *OTHER_KINDS)
    number = F.when(F.col("doubles") > 0, DOUBLE).otherwise(LONG)
    own = F.when(most == 0, NULL)
    for k in OTHER_KINDS:
        own = own.when(F.col(k) == most, k)
    families = families.withColumn("own", own.otherwise(number))
    old = registry.select("payload_type", "field", F.col("kind").alias("old"), F.col("since_version").alias("since"))
    joined = old.join(families, ["payload_type", "field"], "full_outer")
    kind = (F.when(F.col("old").isNull() | (F.col("old") == NULL), F.coalesce("own", "old"))
            .when((F.col("old") == LONG) & (F.coalesce("doubles", F.lit(0)) > 0), DOUBLE).otherwise(F.col("old")))
    joined = joined.withColumn("kind", kind)
    good = F.when(F.col("kind") == DOUBLE, F.col("numbers")).when(F.col("kind") == LONG, F.col("numbers"))
    for k in OTHER_KINDS:
        good = good.when(F.col("kind") == k, F.col(k))
    fitting = F.col("nulls") + good.otherwise(0)
    change = (F.when(F.col("old").isNull(), "added").when(F.col("n_messages").isNull(), "absent")
              .when(F.col("old") != F.col("kind"), "widened").otherwise("same"))
    return joined.select(
        "payload_type", "field", "kind",
        F.when(change.isin("added", "widened"), F.lit(version)).otherwise(F.col("since")).cast("int").alias("since_version"),
        change.alias("change"), F.coalesce("n_messages", F.lit(0)).cast("bigint").alias("n_messages"),
        F.coalesce(F.col("n_messages") - fitting, F.lit(0)).cast("bigint").alias("n_conflicts"))


def conform(messages: DataFrame, registry: DataFrame, text: str = "body_str") -> tuple[DataFrame, DataFrame]:
    """(good, bad) messages: bad are those with a value that does not fit its
    registered field.  Bodies that are no JSON object have no fields and stay
    with the good ones (:func:`split_corrupt` tells them apart).  One narrow
    pass; the registry is a literal of at most ``MAX_FIELDS`` entries."""
    if text not in messages.columns:
        messages = decode_body(messages)
    rows = registry.select("payload_type", "field", "kind").limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} registered fields: are there keys among the field names?")
    known = F.map_from_arrays(*[F.array(*[F.lit(x) for x in column]).cast("array<string>") for column in (
        [f"{r.payload_type}\x00{r.field}" for r in rows], [r.kind for r in rows])])
    def odd_in(fields: Column) -> Column:
        return F.exists(F.map_entries(fields), lambda e: ~F.coalesce(_fits(_kind(e["value"]), F.try_element_at(
            known, F.concat(_payload_type(fields), F.lit("\x00"), e["key"]))), F.lit(True)))

    # as an element of an array the fields are parsed once a message, not once a field
    odd = F.exists(F.array(_fields(text)), odd_in)
    bad = F.coalesce(odd, F.lit(False))
    return messages.where(~bad), messages.where(bad)


def registry(store: Warehouse, release=None) -> DataFrame:
    """The registered fields of the newest (or given) release."""
    release = release or store.release()
    if TABLE not in release.tables:
        return store.spark.createDataFrame([], REGISTRY)
    return store.read(TABLE, release=release)


def register_landing(store: Warehouse, messages: DataFrame,
                     text: str = "body_str") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Take a landing into the registry: (good messages, quarantined messages,
    the report of :func:`evolve`).  A new release is published only where a
    field was added or widened."""
    from feeflow.session import materialize_shared

    base = store.release()
    report = materialize_shared(evolve(registry(store, base), field_kinds(messages, text), base.version + 1), "registry")
    now = report.select(*[c.split()[0] for c in REGISTRY.split(", ")])
    if not report.where(F.col("change").isin("added", "widened")).isEmpty():
        store.publish([store.prepare(TABLE, now.coalesce(1))], base)
    good, bad = conform(messages, now, text)
    return good, bad, report
