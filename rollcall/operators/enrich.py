"""Looking entities up in a registry under candidate ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions import labels
from rollcall.functions.text import append_text
from rollcall.operators.rows import posexplode_rows
from rollcall.session import broadcast_if_small, materialize


def enrich_by_candidates(
    rows: DataFrame,
    registry: DataFrame,
    row_id: str = "row_id",
    name: str = "name",
    company: str = "company",
    org_id: str | None = None,
    source: str = "registry verified",
    locked: str = "registry login required",
    early_stop: bool = False,
) -> DataFrame:
    """Check open rows against the registry; the first candidate that exists decides.

    ``rows`` has one row per ``row_id``; of registry rows with one ``repo_id`` the one with the
    smallest text decides.
    A blank size is filled from the registry and the verification text replaced.
    An entry that needs a login also ends the search, and only adds a remark.
    Other rows pass unchanged. ``matched_id`` tells which entry was used. With
    ``early_stop`` the candidates are looked up in rounds (:func:`hits_in_rounds`), for registries
    in which most first candidates are found.
    """
    org = F.col(org_id) if org_id else F.lit("")
    ids = rows.filter(F.col("openness") == S.OPEN).select(
        row_id, labels.candidate_ids(name, company, org).alias("_ids")
    )
    entry = F.struct(*registry.columns)
    if early_stop:
        hit = hits_in_rounds(ids, registry, row_id)
    else:
        candidates = broadcast_if_small(posexplode_rows(ids, "_ids", "_pos", "repo_id"), "candidates")
        hit = (
            registry.join(candidates, "repo_id")
            .groupBy(row_id)
            .agg(F.min_by(entry, F.struct("_pos", F.to_json(entry))).alias("_hit"))
        )
    wide = rows.join(hit, row_id, "left")
    h = F.col("_hit")
    found = h.isNotNull()
    login = F.coalesce(h["login_required"], F.lit(False))
    size = F.nullif(labels.size_label(h["params_total"]), F.lit(""))
    blank_size = F.coalesce(F.col("size"), F.lit("")) == ""
    text = labels.verification_text(
        source, h["repo_id"], size, labels.license_tag(h["tags"]), h["pipeline_tag"]
    )
    remark = F.concat(F.lit(f"{locked}("), h["repo_id"], F.lit(")"))
    new = {
        "size": F.when(found & ~login & blank_size & size.isNotNull(), size).otherwise(F.col("size")),
        "verification": F.when(login, append_text("verification", remark, " · "))
        .when(found, text)
        .otherwise(F.col("verification")),
    }
    return wide.select(
        *[new.get(c, F.col(c)).alias(c) for c in rows.columns], h["repo_id"].alias("matched_id")
    )


def hits_in_rounds(ids: DataFrame, registry: DataFrame, row_id: str) -> DataFrame:
    """``row_id`` and ``_hit``, the registry entry of the first candidate in ``_ids`` that exists.

    In each round the rows without a hit take their next candidate, so the registry meets as
    many rows as are still open, and no candidate behind a hit is ever looked up. There are as many
    rounds as the longest list has candidates, at most, each a written table.
    """
    open_rows = materialize(ids.filter(F.size("_ids") > 0), "open-rows")
    entry = F.struct(*registry.columns)
    found, at = open_rows.select(row_id, F.lit(None).cast(registry.schema).alias("_hit")).limit(0), 0
    while not open_rows.isEmpty():
        asked = open_rows.select(row_id, F.get("_ids", F.lit(at)).alias("repo_id"))
        hits = materialize(
            registry.join(broadcast_if_small(asked, "asked"), "repo_id")
            .groupBy(row_id).agg(F.min_by(entry, F.to_json(entry)).alias("_hit")),
            "hits",
        )
        found, at = found.unionByName(hits), at + 1
        left = open_rows.filter(F.size("_ids") > at)
        open_rows = materialize(left.join(broadcast_if_small(hits.select(row_id), "done"), row_id, "left_anti"), "open-rows")
    return found
