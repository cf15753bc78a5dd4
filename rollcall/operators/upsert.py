"""Field-level upsert: insert unknown entities, fill blank cells of known ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.dates import dashed, date_int
from rollcall.functions.text import blank_to_null, fill_blank, is_blank, is_product_name, plain_key, strip
from rollcall.operators.dedupe import drop_blank, first_wins
from rollcall.session import broadcast_if_small, materialize


def usable_mentions(
    mentions: DataFrame,
    order: list[str],
    since: int | None = None,
    until: int | None = None,
    date_fallback: bool = False,
) -> DataFrame:
    """Filter before dedupe: product names out, dates outside the window out.

    Undated rows stay. ``date_fallback`` takes the article date instead.
    """
    rows = drop_blank(mentions.withColumn("_key", plain_key("model_name")), F.col("_key"))
    rows = rows.filter(~is_product_name("model_name"))
    day = blank_to_null("release_date")
    if date_fallback:
        source = F.col("source_date").cast("string")
        day = F.coalesce(day, F.when(F.length(source) == 8, dashed(source)))
    rows = rows.withColumn("release_date", F.coalesce(day, F.lit("")))
    if since and until:
        when = date_int("release_date")
        rows = rows.filter(F.coalesce(when.between(since, until), F.lit(True)))
    return first_wins(rows, ["_key"], order)


def upsert_fill(
    catalog: DataFrame,
    incoming: DataFrame,
    fields: dict[str, str] = S.MENTION_TO_CATALOG,
    created_at: str = "",
    row_id: str = "row_id",
    name: str = "name",
    verification: str = "auto-extracted",
) -> DataFrame:
    """Catalog with blank cells filled and unknown entities appended.

    ``incoming`` is the result of :func:`usable_mentions`, one row per ``_key``.
    A filled cell is never overwritten; of several catalog rows with one key the
    last is filled. The catalog is joined on its unique ``row_id`` and not on
    the name, so a name that many rows share is no hot key. ``change`` tells
    what happened: ``insert``, a comma list of filled columns, or nothing.
    """
    pairs = _pairs(catalog, fields)
    # read three times below, and small next to the catalog
    incoming = broadcast_if_small(incoming, "incoming")
    last = (
        catalog.select(plain_key(name).alias("_key"), row_id)
        .join(incoming.select("_key"), "_key", "left_semi")
        .groupBy("_key")
        .agg(F.max(row_id).alias(row_id))
    )
    sided = materialize(incoming.join(last, "_key", "left"), "sided")
    patch = sided.filter(F.col(row_id).isNotNull()).select(
        row_id, *[F.col(c).alias(f"_new_{c}") for c in pairs]
    )
    wide = catalog.join(broadcast_if_small(patch, "patch"), row_id, "left")
    fresh = sided.filter(F.col(row_id).isNull())
    return _filled(wide, catalog.columns, pairs).unionByName(
        _inserted(fresh, catalog, pairs, created_at, row_id, name, verification), allowMissingColumns=True
    )


def upsert_buckets(
    catalog: DataFrame,
    incoming: DataFrame,
    fields: dict[str, str] = S.MENTION_TO_CATALOG,
    created_at: str = "",
    row_id: str = "row_id",
    name: str = "name",
    verification: str = "auto-extracted",
) -> DataFrame:
    """:func:`upsert_fill` of a catalog in buckets of its plain key: only the incoming rows travel.

    ``catalog`` is a table of ``buckets.write_buckets`` with ``plain_key(name)`` as the key. The
    last row of a key is found within its bucket.
    """
    columns = [c for c in catalog.columns if c != "_key"]
    pairs = _pairs(catalog, fields)
    incoming = broadcast_if_small(incoming, "incoming")
    patch = incoming.select("_key", *[F.col(c).alias(f"_new_{c}") for c in pairs])
    last = F.row_number().over(Window.partitionBy("_key").orderBy(F.col(row_id).desc())) == 1
    # joined on the stored key alone, since only that is how the rows lie
    joined = catalog.withColumn("_last", last).join(patch, "_key", "left")
    wide = joined.withColumns({f"_new_{c}": F.when(F.col("_last"), F.col(f"_new_{c}")) for c in pairs})
    known = catalog.select("_key").distinct()
    fresh = incoming.join(known, "_key", "left_anti")
    return _filled(wide, columns, pairs).unionByName(
        _inserted(fresh, catalog.drop("_key"), pairs, created_at, row_id, name, verification), allowMissingColumns=True
    )


def _pairs(catalog: DataFrame, fields: dict[str, str]) -> dict[str, str]:
    """Which incoming column fills which of the catalog."""
    pairs = {**fields, "release_date": "released_at"}
    return {src: target for src, target in pairs.items() if target in catalog.columns}


def _filled(wide: DataFrame, columns: list[str], pairs: dict[str, str]) -> DataFrame:
    """Catalog rows beside their patch (``_new_`` columns) with blank cells filled."""
    tokens = {t: S.BLANK_DATE if t == "released_at" else S.BLANK_FILL for t in pairs.values()}
    source = {target: src for src, target in pairs.items()}
    will = {
        target: is_blank(target, tokens[target]) & blank_to_null(f"_new_{src}").isNotNull()
        for src, target in pairs.items()
    }
    changed = F.array_join(
        F.filter(F.array(*[F.when(cond, F.lit(t)) for t, cond in will.items()]), lambda c: c.isNotNull()), ","
    )
    # row and new names differ, so all cells can be rewritten in one select
    return wide.select(
        *[fill_blank(c, f"_new_{source[c]}", tokens[c]).alias(c) if c in source else F.col(c) for c in columns],
        changed.alias("change"),
    )


def _inserted(
    fresh: DataFrame, catalog: DataFrame, pairs: dict[str, str], created_at: str, row_id: str, name: str, verification: str
) -> DataFrame:
    """Rows of entities the catalog does not know, with its columns as far as they have them."""
    rows = fresh.select(
        F.lit(None).cast(catalog.schema[row_id].dataType).alias(row_id),
        strip("model_name").alias(name),
        *[F.coalesce(F.col(src), F.lit("")).alias(target) for src, target in pairs.items()],
        F.lit(created_at).alias("created_at"),
        F.lit("New").alias("is_new"),
        F.coalesce(
            F.col("verified_by") if "verified_by" in fresh.columns else F.lit(None), F.lit(verification)
        ).alias("verification"),
        F.lit("insert").alias("change"),
    )
    keep = [*catalog.columns, "change"]
    return rows.select(*[c for c in rows.columns if c in keep])
