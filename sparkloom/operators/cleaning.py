"""Cleaning: normalise, redact, and gate by length and language, rejects kept aside with their reason."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import PII_PATTERNS, letters, normalize_text, redact


def _cleaned(c: Column, patterns: Mapping[str, str], html: bool) -> tuple[Column, Column]:
    """(text, counts) of a text normalised once and redacted."""
    both = F.get(F.transform(F.array(normalize_text(F.coalesce(c, F.lit("")), html=html)), lambda t: F.struct(*(x.alias(n) for x, n in zip(redact(t, patterns), "tn", strict=True)))), 0)
    return both["t"], both["n"]


def merged(*counts: Column) -> Column:
    """Maps of counts added up."""
    return reduce(lambda a, b: F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))), counts)


def clean(
    records: DataFrame,
    text: str = "raw_content",
    pair: Sequence[str] = (),
    language: Column | None = None,
    probability: Column | None = None,
    detector: Callable[[Column], Column] | None = None,
    min_chars: int = 40,
    max_chars: int = 50_000,
    min_letters: int = 80,
    min_probability: float = 0.8,
    allowed: Sequence[str] = ("en", "es"),
    trusted: Sequence[str] = (),
    code_categories: Sequence[str] = ("comando_cli", "generacion_yaml", "dockerfile"),
    patterns: Mapping[str, str] = PII_PATTERNS,
    html: bool = True,
    version: int = 1,
) -> DataFrame:
    """``records`` with content, redactions (map of counts), reason (null where accepted) and cleaning.

    The columns named in ``pair`` (system, user, assistant) are normalised and redacted each by itself, null ones stay null;
    their counts are added to the content's. ``detector`` takes the cleaned text and gives struct(language,
    probability); else ``language`` and ``probability`` stand for it. Trusted sources keep their language
    with probability 1, code categories get ``code``; those, and texts that other gates reject, aren't shown to the detector. Length counts code points after cleaning. cleaning is
    struct(language, language_probability, pii_redactions, version).
    """
    names = {c: f"_n_{c}" for c in pair}
    content, counts = _cleaned(F.col(text), patterns, html)
    out = records.withColumns({"content": content, "redactions": counts})
    if pair:
        done = {c: _cleaned(F.col(c), patterns, html) for c in pair}
        out = out.withColumns({names[c]: F.when(F.col(c).isNotNull(), F.struct(t.alias("t"), n.alias("n"))) for c, (t, n) in done.items()})
        none = F.create_map().cast("map<string,bigint>")
        out = out.withColumn("redactions", merged("redactions", *(F.coalesce(F.col(names[c])["n"], none) for c in pair)))
        out = out.withColumns({c: F.col(names[c])["t"] for c in pair}).drop(*names.values())
    trust, code = F.col("source").isin(list(trusted)), F.col("category").isin(list(code_categories))
    few = letters(F.col("content")) < min_letters
    short, long = F.length("content") < min_chars, F.length("content") > max_chars
    if detector is not None:
        # only texts whose language matters are looked at
        out = out.withColumn("_told", detector(F.when(~(F.coalesce(trust, F.lit(False)) | F.coalesce(code, F.lit(False)) | few | short | long), F.col("content"))))
        language, probability = F.col("_told")["language"], F.col("_told")["probability"]
    language = F.col("language") if language is None else language
    probability = F.lit(1.0) if probability is None else probability
    told = F.when(trust, F.coalesce(F.col("language") if "language" in records.columns else F.lit(None).cast("string"), F.lit("en"))).when(code, F.lit("code")).when(~few, language)
    sure = F.when(trust | code, 1.0).when(~few, probability).otherwise(0.0)
    unsure = ~(trust | code) & (few | ~F.coalesce(language.isin(list(allowed)), F.lit(False)) | (probability < min_probability))
    reason = F.when(short, "too_short").when(long, "too_long").when(unsure, "language_not_allowed_or_uncertain")
    done = F.struct(told.alias("language"), F.bround(sure, 6).alias("language_probability"), F.col("redactions").alias("pii_redactions"), F.lit(version).alias("version"))
    return out.withColumns({"reason": reason, "cleaning": done}).drop("_told")


def redaction_totals(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(F.explode("redactions").alias("kind", "n")).groupBy("kind").agg(F.sum("n").alias("n"))


def review_sample(cleaned: DataFrame, size: int, order: str = "ordinal", excerpt: int = 500) -> DataFrame:
    """The first ``size`` accepted records with a redaction, and an excerpt of each."""
    hit = cleaned.where("reason is null and cardinality(redactions) > 0")
    return hit.orderBy(order).limit(size).select(order, F.substring("content", 1, excerpt).alias("excerpt"))
