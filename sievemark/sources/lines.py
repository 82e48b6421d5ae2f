"""Line files: one document per line, raw text or a JSON object with ``text``."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions.plans import settled
from sievemark.functions.text import strip
from sievemark.session import setting
from sievemark.sources.numbering import located, numbered

# Fixed value: the endings that an upload may have, in any case.
UPLOAD_ENDINGS = ("jsonl", "json", "txt")

_REASON = "__reason"
# Python writes and reads these as numbers; strict JSON has null at most. Only outside of strings.
_NOT_A_NUMBER = r"(?<![A-Za-z0-9_])(?:NaN|-?Infinity)(?![A-Za-z0-9_])"
# A line as strings (an unclosed one runs to the end) and what lies between them, in order.
_SEGMENT = r""""(?:[^"\\]|\\.)*+"?|[^"]+"""
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/+"


@dataclass(frozen=True)
class LineDocuments:
    """Readable documents, and the lines whose ``text`` is null or not a string."""

    documents: DataFrame
    rejected: DataFrame


def _with_json(lines: DataFrame) -> DataFrame:
    """Add ``__json``: the line as a one-element variant array, if strict JSON.

    The parser stops after the first complete value, so the line is wrapped: in
    an array, trailing junk is a syntax error. Only junk that itself closes the
    array could slip through; such lines are checked a second time as a member
    of an object. The parsed array is a column of its own, to be built once.
    """
    # One pass over the line: only segments outside strings are rewritten.
    segments = F.regexp_extract_all("__line", F.lit(_SEGMENT), F.lit(0))
    rewritten = F.transform(
        segments, lambda part: F.when(part.startswith('"'), part).otherwise(F.regexp_replace(part, _NOT_A_NUMBER, "null"))
    )
    line = F.when(F.col("__line").rlike("NaN|Infinity"), F.array_join(rewritten, ""))
    lines = lines.withColumn("__strict", F.coalesce(line, F.col("__line")))
    line = F.col("__strict")
    in_array = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), line, F.lit("}")))
    lines = lines.withColumn("__array", F.when(line.startswith("{") & line.endswith("}"), in_array))
    one_value = F.try_variant_get("__array", "$[1]", "variant").isNull()
    whole = one_value & (~line.rlike(r"\}\s*\]") | in_object.isNotNull())
    return lines.withColumn("__json", F.when(F.col("__array").isNotNull() & whole, F.col("__array")))


def documents_from_lines(lines: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Turn a ``value`` column into ``text`` and a reason for rejecting it (null = accepted).

    Blank lines go; a JSON object gives its ``text``; a broken object or one
    without ``text`` stays as the whole line. ``fields`` names further members
    to keep, with their types.
    """
    line = strip(F.col("value"))
    others = [c for c in lines.columns if c != "value"]
    trimmed = lines.select(*others, line.alias("__line")).where(F.col("__line") != "")
    member = _with_json(trimmed).withColumn("__text", F.try_variant_get("__json", "$[0].text", "variant"))
    kind = F.schema_of_variant(F.col("__text"))
    kept_fields = {
        name: F.try_variant_get("__json", f"$[0].{name}", data_type) for name, data_type in (fields or {}).items()
    }
    text = F.when(F.col("__text").isNull(), F.col("__line")).otherwise(F.try_variant_get("__text", "$", "string"))
    reason = F.when(kind == "VOID", F.lit("text is null")).when(
        kind != "STRING", F.concat(F.lit("text is not a string: "), kind)
    )
    return settled(member, others, {"text": text, _REASON: reason, "line": F.col("__line"), **kept_fields})


def _parsed(spark: SparkSession, lines: DataFrame, fields: Mapping[str, str] | None) -> DataFrame:
    """Records of lines. With a repeated member the last one counts, as usual for JSON
    readers: the parser takes that setting in when the expression is resolved."""
    with setting(spark, "spark.sql.variant.allowDuplicateKeys", "true"):
        records = documents_from_lines(lines, fields)
        records.schema  # noqa: B018  resolves it
    return records


def name_filter(endings: Sequence[str]) -> str:
    """A path filter for these file endings, in any case."""
    either = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ending) for ending in endings]
    return "*.{" + ",".join(either) + "}"


def _below(root: str) -> Column:
    """The file's path below ``root``, whatever scheme either is spelled with."""
    folder = re.sub(_SCHEME, "", root).rstrip("/") + "/"
    path = F.regexp_replace("_metadata.file_path", _SCHEME, "")
    # Schemes leave one or more slashes: compare without the leading ones.
    bare, start = F.regexp_replace(path, "^/+", ""), folder.lstrip("/")
    return F.when(bare.startswith(start), F.substring(bare, len(start) + 1, 1 << 30))


def _dataset_id(files: Sequence[str], root: str | None = None) -> Column:
    """The file name; of several files the path below the folder they share; with
    ``root``, always the path below it."""
    if root is not None:
        return _below(root)
    if len(files) == 1:
        return F.col("_metadata.file_name")
    # The same file is spelled file:/x and file:///x in different places.
    shared = posixpath.commonprefix([re.sub(_SCHEME, "", posixpath.dirname(f)) + "/" for f in files])
    below = shared[: shared.rfind("/") + 1]
    path = F.regexp_replace("_metadata.file_path", _SCHEME, "")
    return F.substring(path, F.lit(len(below) + 1), F.length(path))


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    fields: Mapping[str, str] | None = None,
    number: bool = True,
    glob: str | None = None,
    endings: Sequence[str] | None = None,
    root: str | None = None,
) -> LineDocuments:
    """Read line files as ``documents(dataset_id, line_no, text, …fields)``.

    Every file is read whatever its name, compressed ones as their ending says.
    ``glob`` or ``endings`` (in any case, see ``UPLOAD_ENDINGS``) restrict that; paths
    that leave no file to read are an error. ``dataset_id`` is the file name, or with
    several files the path below the folder they share, so that keys are unique.
    ``line_no`` is the 1-based physical line in its file. ``number=False`` leaves
    it out and saves the extra pass where documents carry their own id.

    Ids of that kind move when another folder is read along. With ``root`` (a folder
    above all paths) a file's id is its path below ``root`` in every read, batch or
    stream, so ids stay as a corpus grows; a file outside ``root`` is an error.
    """
    reader = spark.read
    if glob or endings:
        reader = reader.option("pathGlobFilter", glob or name_filter(endings))
    scan = reader.text(paths if isinstance(paths, str) else list(paths))
    files = scan.inputFiles()
    if not files:
        raise FileNotFoundError(f"no file to read in {paths}")
    if root is not None:
        outside = [f for f in files if not re.sub(_SCHEME, "", f).lstrip("/").startswith(re.sub(_SCHEME, "", root).strip("/") + "/")]
        if outside:
            raise ValueError(f"{outside[0]} lies outside {root}")
    lines = located(scan.select("value", _dataset_id(files, root).alias("dataset_id"), "_metadata"))
    lines = lines.drop("_metadata")
    lines = numbered(lines) if number else lines.drop("__file", "__block")
    records = _parsed(spark, lines, fields)
    keys = ["dataset_id", "line_no"] if number else ["dataset_id"]
    return LineDocuments(
        documents=records.where(F.col(_REASON).isNull()).select(*keys, "text", *(fields or {})),
        rejected=records.where(F.col(_REASON).isNotNull()).select(
            *keys, "line", F.col(_REASON).alias("reason")
        ),
    )


def stream_lines(
    spark: SparkSession,
    path: str,
    fields: Mapping[str, str] | None = None,
    glob: str | None = None,
    endings: Sequence[str] | None = None,
    max_files_per_trigger: int | None = None,
    root: str | None = None,
) -> LineDocuments:
    """The same records from arriving files, without line numbers.

    Without ``root`` a file's id is its name; with it, its path below ``root``, as in
    ``read_lines``, so that equally named files of two folders keep apart.
    """
    reader = spark.readStream
    if glob or endings:
        reader = reader.option("pathGlobFilter", glob or name_filter(endings))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    name = _below(root) if root is not None else F.col("_metadata.file_name")
    lines = reader.text(path).select("value", name.alias("dataset_id"))
    records = _parsed(spark, lines, fields)
    return LineDocuments(
        documents=records.where(F.col(_REASON).isNull()).select("dataset_id", "text", *(fields or {})),
        rejected=records.where(F.col(_REASON).isNotNull()).select(
            "dataset_id", "line", F.col(_REASON).alias("reason")
        ),
    )
