"""Files: verified Parquet, Markdown trees, manifests of a directory."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.shipping import ship
from sparkloom.sources import hadoop


def verified_parquet(spark: SparkSession, path: str, sha256: str | None = None, revision: str | None = None) -> DataFrame:
    """A Parquet file or folder whose magic numbers, and digest where given, are right; raises otherwise.

    Only head and tail of each file are read for the check, or, for the digest, the file in pieces. With a
    ``revision`` (of an immutable snapshot) the records carry it as source_revision.
    """
    for f in hadoop.files_below(spark, path):
        if not hadoop.has_magic(spark, f):
            raise ValueError(f"{f} is not a Parquet file")
        if sha256 and hadoop.sha256_of(spark, f) != sha256:
            raise ValueError(f"{f} has another digest than expected")
    df = spark.read.parquet(path)
    return df.withColumn("source_revision", F.lit(revision)) if revision else df


def resolved(spark: SparkSession, root: str, ref: str) -> tuple[str, str]:
    """(folder, revision) of a dataset snapshot: ``root/refs/<ref>`` names the revision, whose files are in ``root/snapshots/<revision>``."""
    revision = ref
    if hadoop.exists(spark, f"{root}/refs/{ref}"):
        revision = spark.read.text(f"{root}/refs/{ref}").first()[0].strip()
    folder = f"{root}/snapshots/{revision}"
    if not hadoop.exists(spark, folder):
        raise FileNotFoundError(f"{root} has no snapshot {ref}")
    return folder, revision


def _globs(patterns: Sequence[str], column: Column) -> Column:
    """Whether a path matches one of the patterns; ``**/`` is any number of folders, none too."""
    out = F.lit(False)
    for p in patterns:
        regex = "".join("(?:.*/)?" if x == "**/" else ".*" if x == "**" else "[^/]*" if x == "*" else "[^/]" if x == "?" else re.escape(x) for x in re.split(r"(\*\*/|\*\*|\*|\?)", p))
        out = out | column.rlike(f"^{regex}$")
    return out


def _fnmatches(patterns: Sequence[str], column: Column) -> Column:
    """Whether a path matches one of the shell patterns, whose stars match slashes too."""
    out = F.lit(False)
    for p in patterns:
        out = out | column.rlike(fnmatch.translate(p).replace(r"\Z", "$").replace(r"\z", "$"))
    return out


def relative(root: str, path: Column) -> Column:
    """A file's path below the root, with slashes."""
    tail = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).strip("/") + "/"
    return F.substring_index(path, tail, -1) if tail != "//" else path


def tree(spark: SparkSession, root: str, include: Sequence[str] = ("**/*.md",), exclude: Sequence[str] = ()) -> DataFrame:
    """(path, content) of the files below a root whose path below it matches; several patterns name a file once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = files.select(relative(root, F.col("path")).alias("path"), "content")
    return files.where(_globs(include, F.col("path")) & ~_fnmatches(exclude, F.col("path")))


def markdown_files(spark: SparkSession, root: str, include: Sequence[str] = ("**/*.md",), exclude: Sequence[str] = (), replace_invalid: bool = False) -> DataFrame:
    """(path, text) of the Markdown files below a root; files that aren't UTF-8 are skipped, or mended."""
    files = tree(spark, root, include, exclude)
    if replace_invalid:
        return files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    return files.where(F.is_valid_utf8(F.col("content").cast("string"))).select("path", F.col("content").cast("string").alias("text"))


def record_url(repository: str, revision: str, path: Column) -> Column:
    """The page of a file at a revision, in the host's style."""
    repository = repository.removesuffix(".git")
    middle = "blob" if repository.startswith("https://github.com/") else "src/commit"
    return F.concat(F.lit(f"{repository}/{middle}/{revision}/"), path)


def index_records(spark: SparkSession, root: str, fallback: str | None, source: str, repository: str, revision: str, include: Sequence[str] = ("**/*.md",), exclude: Sequence[str] = ()) -> DataFrame:
    """Whole files of an index without a licence, for quarantine: bytes that aren't UTF-8 are replaced, blank files left out.

    Where ``root`` isn't there the ``fallback`` folder is read.
    """
    if not hadoop.exists(spark, root):
        if fallback is None:
            raise FileNotFoundError(root)
        root = fallback
    files = markdown_files(spark, root, include, exclude, replace_invalid=True).where(F.col("text").rlike(r"\S"))
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select(
        F.lit(source).alias("source"), F.lit("troubleshooting").alias("category"), F.col("text").alias("raw_content"), F.lit("unknown").alias("license"),
        record_url(repository, revision, F.col("path")).alias("url"), F.sha2(F.concat_ws(":", F.lit(revision), "path"), 256).alias("source_record_id"), F.lit(revision).alias("source_revision"),
        F.col("path").alias("source_path"), name.alias("title"), F.concat(F.lit("Unlicensed index only: "), "path", F.lit(f" @ {revision}")).alias("attribution"),
        F.lit(False).alias("include_in_final"), F.lit(True).alias("requires_link_license_audit"),
    )


def directory_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of every file below a root; an empty folder is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    out = files.select(relative(root, F.col("path")).alias("path"), F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    if not hadoop.files_below(spark, root):
        raise ValueError(f"{root} holds no files")
    return out


def directory_mismatches(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Files of a manifest (path below the root, bytes, sha256) that are missing, differ or lie outside, and files that it doesn't have."""
    seen = directory_manifest(spark, root).select("path", F.col("bytes").alias("seen_bytes"), F.col("sha256").alias("seen_sha256"))
    both = manifest.join(seen, "path", "full_outer")
    outside = F.coalesce(F.col("path").rlike(r"^/|(^|/)\.\.(/|$)"), F.lit(True))
    return both.where(outside | ~F.col("bytes").eqNullSafe(F.col("seen_bytes")) | ~F.col("sha256").eqNullSafe(F.col("seen_sha256")))


#: Front matter at the top of a file, and a heading line.
FRONT_MATTER = re.compile(r"\A---\s*\n.*?\n---\s*\n", re.DOTALL)
HEADING = re.compile(r"^(#{1,6})\s+(.+)$")


def sections(text: str) -> Iterator[tuple[str, str]]:
    """(title, body) of the stretches between headings; headings inside fences don't count."""
    title, held, fenced = "Untitled", [], False
    for line in FRONT_MATTER.sub("", text.replace("\r\n", "\n"), count=1).splitlines():
        fenced ^= line.lstrip().startswith(("```", "~~~"))
        found = None if fenced else HEADING.match(line)
        if found:
            if body := "\n".join(held).strip():
                yield title, body
            title, held = found[2].strip(), []
        held.append(line)
    if body := "\n".join(held).strip():
        yield title, body


def pieces(body: str, most: int, overlap: int) -> Iterator[str]:
    """The paragraphs of a body, long ones cut with overlap; long ones with a fence are left out."""
    for paragraph in filter(None, (p.strip() for p in re.split(r"\n{2,}", body))):
        if len(paragraph) <= most:
            yield paragraph
        elif "```" not in paragraph and "~~~" not in paragraph:
            for at in range(0, len(paragraph), max(1, most - overlap)):
                yield paragraph[at : at + most]


def chunk_markdown(text: str, least: int, most: int, overlap: int) -> list[tuple[str, str]]:
    """(title, chunk): sections of at most ``most`` characters, longer ones by paragraphs with some overlap."""
    out: list[tuple[str, str]] = []
    for title, body in sections(text):
        made = [body] if len(body) <= most else []
        if not made:
            now = ""
            for piece in pieces(body, most, overlap):
                joined = f"{now}\n\n{piece}".strip()
                if len(joined) > most:
                    made.append(now)
                    room = min(overlap, max(0, most - len(piece) - 2))
                    joined = f"{now[len(now) - room:] if room else ''}\n\n{piece}".strip()
                now = joined
            made.append(now)
        out += [(title, x) for x in made if len(x) >= least]
    if any(len(x) > most for _, x in out):
        raise ValueError(f"a chunk is longer than {most} characters")
    return out


def markdown_chunks(files: DataFrame, least: int = 300, most: int = 12_000, overlap: int = 300, revision: str = "") -> DataFrame:
    """(path, chunk_index, title, chunk, record_id) of (path, text); the id is over revision, path, index and chunk."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, i, t, c) for p, x in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True) for i, (t, c) in enumerate(chunk_markdown(x or "", least, most, overlap))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], ["path", "chunk_index", "title", "chunk"])

    out = files.select("path", "text").mapInArrow(run, "path string, chunk_index int, title string, chunk string")
    return out.withColumn("record_id", F.sha2(F.concat(F.lit(f"{revision}:"), F.col("path"), F.lit(":"), F.col("chunk_index").cast("string"), F.lit(":"), F.col("chunk")), 256))


def markdown_records(chunks: DataFrame, source: str, repository: str, revision: str, license_: str, category: Column, license_url: str | None = None, normalization: str | None = None, most: int | None = None) -> DataFrame:
    """Chunks as interim records with their page and attribution; ``most`` keeps the first records in order of path and chunk."""
    out = chunks.select(
        F.lit(source).alias("source"), category.alias("category"), F.col("chunk").alias("raw_content"), F.lit(license_).alias("license"), F.lit(license_url).alias("license_url"),
        record_url(repository, revision, F.col("path")).alias("url"), F.col("record_id").alias("source_record_id"), F.lit(revision).alias("source_revision"), F.col("path").alias("source_path"), "title",
        F.concat(F.lit(f"{source}: "), "path", F.lit(f" @ {revision}")).alias("attribution"), F.lit("en").alias("language"), "chunk_index", F.lit(normalization).alias("normalization"),
    )
    return out if most is None else out.orderBy("source_path", "chunk_index").limit(most)
