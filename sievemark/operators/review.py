"""Review of flagged documents and re-applying the reviewer's decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.operators.report import FLAGGED_EXPLICIT, FLAGGED_SENSITIVE, SENSITIVE_CATEGORIES

KEYS = ("dataset_id", "line_no")

# Names of the review filters and the page limits.
FILTER_EXPLICIT = "porn"
FILTER_SENSITIVE = "3r"
DEFAULT_PER_PAGE = 20
MAX_PER_PAGE = 100

# A reviewer's keep list below this size (bytes of its keys) is broadcast.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def review_filter(flagged: DataFrame, kind: str = "all") -> DataFrame:
    """Flagged documents of one kind; an unknown kind means all."""
    if kind == FILTER_EXPLICIT:
        return flagged.where(F.col(FLAGGED_EXPLICIT))
    if kind == FILTER_SENSITIVE:
        return flagged.where(F.col(FLAGGED_SENSITIVE))
    known = [c.removesuffix("_keywords") for c in flagged.columns if c.endswith("_keywords")]
    if kind in known:
        return flagged.where(F.array_contains(SENSITIVE_CATEGORIES, kind.upper()))
    return flagged


def review_search(flagged: DataFrame, query: str = "") -> DataFrame:
    """Flagged documents whose preview holds ``query`` literally, in any case."""
    wanted = query.lower().strip()
    return flagged.where(F.lower("text_preview").contains(wanted)) if wanted else flagged


def review_page(
    flagged: DataFrame,
    page: int = 1,
    per_page: int = DEFAULT_PER_PAGE,
    keys: Sequence[str] = KEYS,
    after: Sequence | None = None,
) -> DataFrame:
    """One page in key order.

    ``after`` holds the keys of the last row seen: the page then follows that row, and
    no more than one page is gathered however deep it lies. By ``page`` number all
    rows up to the page's end are gathered, which suits the first pages only.
    """
    page, per_page = _limits(page, per_page)
    if after is not None:
        behind, same = F.lit(False), F.lit(True)
        for key, value in zip(keys, after, strict=True):
            behind = behind | (same & (F.col(key) > F.lit(value)))
            same = same & (F.col(key) == F.lit(value))
        return flagged.where(behind).orderBy(*keys).limit(per_page)
    return flagged.orderBy(*keys).offset((page - 1) * per_page).limit(per_page)


def review_totals(flagged: DataFrame, per_page: int = DEFAULT_PER_PAGE) -> DataFrame:
    """Number of rows and pages; zero pages when there is nothing."""
    _, per_page = _limits(1, per_page)
    total = F.count(F.lit(1))
    return flagged.agg(
        total.alias("total"), F.ceil(total / F.lit(per_page)).cast("long").alias("total_pages")
    )


def _limits(page: int, per_page: int) -> tuple[int, int]:
    return max(1, int(page)), max(1, min(int(per_page), MAX_PER_PAGE))


def _keep_keys(decisions: DataFrame, keys: Sequence[str]) -> DataFrame:
    if "decision" in decisions.columns:
        decisions = decisions.where(F.col("decision") == "keep")
    return decisions.select(*keys)


def removed_keys(flagged: DataFrame, decisions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct flagged documents that no reviewer wants to keep."""
    return flagged.select(*keys).distinct().join(_keep_keys(decisions, keys), list(keys), "left_anti")


def reapply(
    documents: DataFrame, flagged: DataFrame, decisions: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """All documents except those still removed.

    For when only the original documents and a flagged report exist: both sides
    meet on the key. :func:`reapply_scored` avoids moving the documents.
    """
    return documents.join(removed_keys(flagged, decisions, keys), list(keys), "left_anti")


def reapply_scored(scored: DataFrame, decisions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The same from scored documents: kept ones pass straight through.

    Only flagged documents are joined. On a scored table partitioned by
    ``keep`` each branch reads just its own part.
    """
    keep_keys = _keep_keys(decisions, keys).distinct()
    size = keep_keys.agg(F.sum(_key_bytes(keys))).first()[0] or 0
    if size <= MAX_BROADCAST_BYTES:
        keep_keys = F.broadcast(keep_keys)
    restored = scored.where(~F.col("keep")).join(keep_keys, list(keys), "left_semi")
    return scored.where(F.col("keep")).select(*keys, *_others(scored, keys)).unionByName(
        restored.select(*keys, *_others(scored, keys))
    )


def _others(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def _key_bytes(keys: Sequence[str]) -> Column:
    return sum((F.length(F.col(k).cast("string")) for k in keys), F.lit(32))


def reapply_counts(
    documents: DataFrame, flagged: DataFrame, decisions: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """``records_written`` and ``records_removed`` (removed keys, not dropped rows).

    Written are all rows but those of removed keys: three counts, and only the keys of
    the last one meet in a join.
    """
    removed = removed_keys(flagged, decisions, keys)
    parts = (
        documents.select(F.lit(1).alias("total"), F.lit(0).alias("gone"), F.lit(0).alias("removed")),
        documents.select(*keys).join(removed, list(keys), "left_semi").select(F.lit(0), F.lit(1), F.lit(0)),
        removed.select(F.lit(0), F.lit(0), F.lit(1)),
    )
    counted = parts[0].union(parts[1]).union(parts[2]).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "gone", "removed")])
    return counted.select((F.col("total") - F.col("gone")).alias("records_written"), F.col("removed").alias("records_removed"))
