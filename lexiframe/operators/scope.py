"""Which catalogue tables a plan may touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.constants import DEFAULT_PREFIX
from lexiframe.functions.names import (
    build_table_fqn,
    normalize_table_code,
)
from lexiframe.functions.text import strip
from lexiframe.operators.skew import spread_join

_PRODUCT_KEYS = ["id", "name", "fullyQualifiedName", "displayName"]


def scope_include(sources: DataFrame, codes: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """Keep rows whose code is in `codes(table_code)`, compared in normalised form.

    `sources` may be `src_tables` or the far longer `src_columns`.
    """
    wanted = codes.select(normalize_table_code(F.col("table_code"), prefix).alias("table_code"))
    return spread_join(sources, wanted.distinct(), ["table_code"], "left_semi")


def scope_active(
    src_tables: DataFrame, active: DataFrame, service: str, database: str, schema: str
) -> DataFrame:
    """Source tables in the active list with their full names."""
    codes = active.filter(F.col("table_code").isNotNull()).select("table_code").distinct()
    kept = src_tables.join(codes, "table_code", "left_semi")
    return kept.withColumn(
        "table_fqn",
        build_table_fqn(F.lit(service), F.lit(database), F.lit(schema), F.col("warehouse_table_name")),
    )


def _truthy(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(value, F.lit("")) for value in values])


def product_assets(products: DataFrame) -> DataFrame:
    """Table names among the assets of each product; an asset may nest its `entity`.

    `products(product_id, assets)` with assets as JSON texts.
    """
    attributes = (
        "struct<type: string, entityType: string, entityTypeName: string, "
        "fullyQualifiedName: string, fqn: string, href: string>"
    )
    asset = f"struct<name: string, entity: {attributes}, {attributes[len('struct<') :]}"
    rows = products.select("product_id", F.explode("assets").alias("text")).select(
        "product_id", F.from_json("text", asset).alias("a")
    )
    nested = F.col("a.entity").isNotNull()

    def value(name: str) -> Column:
        return F.when(nested, F.col(f"a.entity.{name}")).otherwise(F.col(f"a.{name}"))

    kind = F.lower(
        F.coalesce(
            _truthy(value("type"), value("entityType"), value("entityTypeName")), F.lit("")
        )
    )
    fqn = _truthy(value("fullyQualifiedName"), value("fqn"), F.col("a.name"))
    is_table = F.contains(kind, F.lit("table")) | (kind == "")
    by_link = F.coalesce(F.contains(value("href"), F.lit("/tables/")), F.lit(False))
    return (
        rows.select("product_id", fqn.alias("table_fqn"), (is_table | by_link).alias("_keep"))
        .filter("_keep AND table_fqn IS NOT NULL")
        .select("product_id", "table_fqn")
        .distinct()
    )


def scope_schema(
    frame: DataFrame, service: str, database: str, schema: str, whole_name: bool = False
) -> DataFrame:
    """Rows whose `table_fqn` starts with the schema name; with `whole_name`, rows of that schema
    alone and not of another whose name begins with it."""
    start = ".".join([service.strip(), database.strip(), schema.strip(), ""]).rstrip(".")
    return frame.filter(F.col("table_fqn").startswith(start + "." * whole_name))


def product_members(cat_tables: DataFrame, products: DataFrame) -> DataFrame:
    """Tables that share an id, name, full name or display name with a product.

    Both sides become one row per value, so this is an equi-join; `products` is the short side.
    """
    values = lambda row: F.array(*[row[name] for name in _PRODUCT_KEYS])
    refs = cat_tables.select(
        "table_fqn",
        F.explode(F.array_distinct(F.flatten(F.transform("data_products", values)))).alias("value"),
    ).filter("value <> ''")
    named = products.select(
        F.col("id").alias("product_id"),
        F.explode(F.array_distinct(F.array(*[F.col(name) for name in _PRODUCT_KEYS]))).alias("value"),
    ).filter("value <> ''")
    # One name may belong to several products; the join needs unique keys on the short side only
    # for its size, not for its result.
    return spread_join(refs, named, ["value"]).select("table_fqn", "product_id").distinct()


def resolve_product(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Product of each requested name: the first spelling that exists.

    Spellings in order: as given, trimmed, with a leading space, the part behind the first dot,
    and that part with a leading space.
    """
    asked = F.col("requested")
    bare = strip(asked)
    has_dot = F.contains(bare, F.lit("."))
    tail = F.when(has_dot, strip(F.regexp_replace(bare, r"(?s)\A[^.]*\.", "")))
    spellings = F.array(asked, bare, F.concat(F.lit(" "), bare), tail, F.concat(F.lit(" "), tail))
    candidates = (
        requests.select("requested")
        .distinct()
        .select("requested", F.posexplode(spellings).alias("rank", "fullyQualifiedName"))
        .filter("fullyQualifiedName <> ''")
    )
    hits = candidates.join(products, "fullyQualifiedName")
    return hits.groupBy("requested").agg(
        F.min_by("fullyQualifiedName", "rank").alias("product_fqn"), F.min("rank").alias("rank")
    )


def scope_tables(
    cat_tables: DataFrame,
    active: DataFrame,
    assets: DataFrame,
    members: DataFrame,
    service: str,
    database: str,
    schema: str,
    require_membership: bool = True,
) -> DataFrame:
    """Scoped names: the active list if it has any, else the assets, else the schema's members.

    `active`, `assets` and `members` are `(table_fqn)` relations for the chosen product. Which one
    counts is decided while the job runs, by two scalar subqueries.
    """
    names = cat_tables.select("table_fqn").distinct()
    in_schema = lambda frame: scope_schema(
        frame.select("table_fqn").distinct(), service, database, schema
    )
    owned = in_schema(assets)
    listed = names.join(active.select("table_fqn").distinct(), "table_fqn", "left_semi")
    if require_membership:
        listed = listed.join(members.select("table_fqn").distinct(), "table_fqn", "left_semi")
    active_rows = active.agg(F.count(F.lit(1))).scalar()
    asset_rows = owned.agg(F.count(F.lit(1))).scalar()
    own = scope_schema(names, service, database, schema, whole_name=True)
    schema_members = own.join(
        members.select("table_fqn").distinct(), "table_fqn", "left_semi"
    )
    return (
        listed.filter(active_rows > 0)
        .unionByName(owned.filter((active_rows == 0) & (asset_rows > 0)))
        .unionByName(schema_members.filter((active_rows == 0) & (asset_rows == 0)))
    )
