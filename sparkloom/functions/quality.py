"""Measures and flags of question and answer pairs, hardness features, n-gram repetition."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.text import let, lines_of, py_rstrip, py_strip

#: Shapes of lines and words that the measures count.
BULLET = r"^\s*(?:[-*+]|\d+[.)])\s+\S"
HEADING = r"^\s*#{1,6}\s+\S"
VERSION = r"(?U)\bv?\d+\.\d+(?:\.\d+)?\b"
TABLE_ROW = r"^\s*\|.*\|\s*$"
RULE = r"^\s*(?:-{3,}|_{3,}|\*{3,})\s*$"
ISSUE = r"(?U)(?:\b[\w.-]+/[\w.-]+#\d+|\(#\d{2,}\)|\[#\d{2,}\])"
CHANGELOG = r"(?i)^\s*#{1,6}\s*(?:v?\d+\.\d+|bug ?fixes|fixes|new\b|upgrades|updates|deprecat|removed|removals|breaking|known issues|release notes|changelog|what'?s new|enhancements|for (?:all platforms|windows|mac|linux))"
TEMPLATE = r"\{\{[<%]|[>%]\}\}|\]\(/(?:docs|[a-z]{2}/docs)/|\{\{\s*\."
CONTEXT = (
    r"(?iU)\b(?:seg[uú]n (?:la informaci[oó]n|el (?:texto|documento|fragmento|contenido|pasaje))"
    r"|(?:informaci[oó]n|texto|documento|fragmento|contenido) proporcionad[oa]"
    r"|(?:en|del) (?:el )?(?:fragmento|texto|documento|pasaje) (?:anterior|dado|siguiente)"
    r"|(?:mencionad[oa]s?|descrit[oa]s?|indicad[oa]s?) en (?:el|la) (?:texto|documento|fragmento|informaci[oó]n))"
)
ENUMERATION = (
    r"(?iU)\b(?:enumera|lista|listar|todos|todas|cu[aá]les son|qu[eé] (?:pasos|opciones|cambios|comandos|"
    r"requisitos|campos|tipos|funcionalidades|mejoras|correcciones)|pasos|list|all)\b"
)
SPANISH = (
    "el la los las de del que en y para por con una un es se como al lo su sus más pero "
    "este esta estos estas cuando puede pueden debe hay también sobre entre"
).split()
ENGLISH = "the of and to in is for that with this are be as on it by can you an or from if when will which not your should must have".split()
QUESTION_WORDS = "qué cuál cuáles cómo explica describe enumera indica genera muestra proporciona detalla lista todos todas incluyendo según información".split()

#: Thresholds of the audit.
THRESHOLDS = {"bullets": 10, "length_ratio": 15, "term_recall": 0.3, "versions": 10, "narrow_list_bullets": 5}

#: The features of a hard case and what gives each away.
COMPONENTS = "kubelet coredns etcd ingress containerd scheduler".split()
HARD_FEATURES = {
    "multi_step_diagnosis": r"(?U)\b(first|then|next|step|after|before|investigate|diagnos)\b",
    "contains_logs_or_events": r"(?U)\b(error|failed|event|log|traceback|exception)\b",
    "requires_resource_constraints_reasoning": r"(?U)\b(oom|memory|cpu|limit|request|evict|throttl)\b",
    "networking_or_dns_edge_case": r"(?U)\b(dns|network|cni|service|ingress|endpoint|connection)\b",
    "storage_or_etcd_edge_case": r"(?U)\b(storage|volume|pvc|etcd|mount|filesystem)\b",
    "misleading_symptom": r"(?U)\b(but|although|despite|intermittent|only one|works locally)\b",
}


def count_lines(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: x.rlike(pattern)))


def words(c: Column) -> Column:
    """Lower case words, which may hold dots, hyphens and slashes inside."""
    found = F.regexp_extract_all(c, F.lit(r"(?U)[\w.\-/]+"), F.lit(0))
    return F.transform(found, lambda w: F.lower(F.regexp_replace(w, r"^[.\-/]+|[.\-/]+$", "")))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\S+"))


def spanish_share(c: Column) -> Column:
    """Share of Spanish among the stop words of two languages; null for fewer than five."""
    def share(w: Column) -> Column:
        es, en = F.size(F.filter(w, lambda x: x.isin(SPANISH))), F.size(F.filter(w, lambda x: x.isin(ENGLISH)))
        return F.when(es + en >= 5, es / (es + en))

    return let(words(c), share)


def question_term_recall(question: Column, answer: Column) -> Column:
    """Share of the question's distinctive words that the answer has; null if there are none."""
    stop = sorted({*SPANISH, *ENGLISH, *QUESTION_WORDS})
    terms = F.array_distinct(F.filter(words(question), lambda w: (F.length(w) >= 4) & ~w.isin(stop) & ~w.rlike(r"^\d+$")))
    return F.when(F.size(terms) > 0, F.size(F.array_intersect(terms, words(answer))) / F.size(terms))


def ends_in_structure(answer: Column) -> Column:
    """Whether the last line that isn't blank is part of a list, table, heading, rule or template, or ends in : or ,."""
    lines = F.filter(lines_of(py_strip(answer)), lambda x: py_strip(x) != "")

    def open_end(x: Column) -> Column:
        hit = reduce(lambda a, b: a | b, (x.rlike(p) for p in (BULLET, TABLE_ROW, HEADING, RULE, TEMPLATE)))
        return hit | py_rstrip(x).rlike("[:,]$")

    return let(lines, lambda x: F.when(F.size(x) == 0, True).otherwise(let(F.element_at(x, -1), open_end)))


def is_release_notes(answer: Column) -> Column:
    issues = lambda lines: F.size(F.filter(lines, lambda x: x.rlike(BULLET) & x.rlike(ISSUE)))
    return let(lines_of(answer), lambda x: (issues(x) >= 3) | ((count_lines(x, CHANGELOG) >= 1) & (count_lines(x, BULLET) >= 3)))


def measure(question: Column, answer: Column, category: Column) -> dict[str, Column]:
    """Fifteen measures of a pair; lists and languages aren't judged in YAML answers."""
    yaml, lines = category == "generacion_yaml", lines_of(answer)
    return {
        "question_words": word_count(question),
        "answer_words": word_count(answer),
        "length_ratio": word_count(answer) / F.greatest(word_count(question), F.lit(1)),
        "bullets": F.when(yaml, 0).otherwise(count_lines(lines, BULLET)),
        "headings": count_lines(lines, HEADING),
        "versions": F.regexp_count(answer, F.lit(VERSION)),
        "template_residue": answer.rlike(TEMPLATE),
        "context_reference": question.rlike(CONTEXT),
        "starts_with_heading": F.coalesce(F.get(lines, 0).rlike(HEADING), F.lit(False)),
        "ends_in_structure": ~yaml & ends_in_structure(answer),
        "release_notes": ~yaml & is_release_notes(answer),
        "narrow_question": ~question.rlike(ENUMERATION),
        "question_spanish_share": F.when(~yaml, spanish_share(question)),
        "answer_spanish_share": F.when(~yaml, spanish_share(answer)),
        "term_recall": question_term_recall(question, answer),
    }


def flags(t: Mapping[str, float] = THRESHOLDS) -> Column:
    """The names of the rules that columns called as in ``measure`` break, in order."""
    c = F.col
    rules = {
        "long_list": c("bullets") >= t["bullets"],
        "template_residue": c("template_residue"),
        "context_reference": c("context_reference"),
        "ends_in_structure": c("ends_in_structure"),
        "release_notes": c("release_notes"),
        "narrow_question_list_answer": c("narrow_question") & (c("bullets") >= t["narrow_list_bullets"]),
        "length_imbalance": c("length_ratio") >= t["length_ratio"],
        "language_mismatch": (c("question_spanish_share") >= 0.5) & (c("answer_spanish_share") < 0.5),
        "version_dense": c("versions") >= t["versions"],
    }
    return F.array_compact(F.array(*(F.when(rule, name) for name, rule in rules.items())))


#: Flags for which a reverse-instruction record leaves the training set.
TIER_A = ("long_list", "narrow_question_list_answer", "release_notes")


def hard_features(text: Column) -> Column:
    text = F.lower(text)
    several = reduce(lambda a, b: a + b, (text.contains(w).cast("int") for w in COMPONENTS)) >= 2
    found = [F.when(several, "multiple_components")]
    for name, pattern in HARD_FEATURES.items():
        hit = text.rlike(pattern)
        found.append(F.when(hit | text.contains("```") if name == "contains_logs_or_events" else hit, name))
    return F.array_compact(F.array(*found))


def repeated_ngram_ratio(c: Column, n: int) -> Column:
    """Share of the n-grams of words that repeat an earlier one; 0 for a text of fewer than n words."""
    w = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0))
    share = lambda g: (F.size(g) - F.size(F.array_distinct(g))) / F.size(g)
    grams = lambda x: F.transform(F.sequence(F.lit(1), F.size(x) - (n - 1)), lambda i: F.array_join(F.slice(x, i, n), " "))
    return let(w, lambda x: F.when(F.size(x) >= n, let(grams(x), share)).otherwise(0.0))
