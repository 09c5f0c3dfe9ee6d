"""Text expressions, built in wherever Spark has the means.

Regular expressions carry ``(?U)`` where Unicode classes are meant. The few functions that no built-in
expresses (NFKC, HTML to text) are Arrow UDFs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as personal data or a secret, in the order in which it is redacted.
PII_PATTERNS: dict[str, str] = {
    "email": r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "private_ipv4": r"\b(?:10(?:\.\d{1,3}){3}|192\.168(?:\.\d{1,3}){2}|172\.(?:1[6-9]|2\d|3[01])(?:\.\d{1,3}){2})\b",
    "aws_access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "github_token": r"\b(?:gh[pousr]_[A-Za-z0-9]{20,255}|github_pat_[A-Za-z0-9_]{20,255})\b",
    "jwt": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\b",
    "bearer_token": r"(?i)(?<=Bearer )[A-Za-z0-9._~+/-]{16,}={0,2}",
}

#: Lines that belong to a page's furniture.
BOILERPLATE = (r"^\s*(edit this page|view page source|last modified|copyright)\b.*$", r"^\s*(previous|next)\s*$")


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c computed once, however often f uses it: keeps nested expressions from multiplying."""
    return F.get(F.transform(F.array(c), f), 0)


#: Fixed value: the characters that Python's str.strip() takes for white space.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def py_strip(c: Column) -> Column:
    """White space off both ends, as Python's strip() does; linear, where a pattern would try every start in a run of blanks."""
    return F.btrim(c, F.lit(BLANKS))


def py_rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANKS))


def lines_of(c: Column) -> Column:
    """The lines of a text, at all of Unicode's line ends; a line end at the very end starts no further line."""
    parts = F.split(c, "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x85\\u2028\\u2029]")
    return let(parts, lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, 1, F.size(x) - 1)).otherwise(x))


def unix_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


#: A line that opens and closes a fence, and one that begins with a fence.
EMPTY_FENCE, FENCE_LINE = r"(?m)^\s*```\s*```\s*$", r"(?m)^\s*```"


def repair_fences(c: Column) -> Column:
    """Without lines that only open and close a fence; an open fence at the end is closed."""
    out = F.regexp_replace(c, EMPTY_FENCE, "")
    odd = lambda x: F.regexp_count(x, F.lit(FENCE_LINE)) % 2 == 1
    return let(out, lambda x: F.when(odd(x), F.concat(py_rstrip(x), F.lit("\n```"))).otherwise(x))


def normalize_text(c: Column, boilerplate: Sequence[str] = BOILERPLATE, html: bool = True) -> Column:
    """Text of HTML, Unix line ends, no trailing blanks, no boilerplate lines, at most one empty line in a row, fences closed.

    Without ``html`` tags are left as they are (for columns that are known to hold none).
    """
    lines = F.transform(lines_of(unix_newlines(html_to_text(c) if html else c)), py_rstrip)
    kept = reduce(lambda a, p: F.filter(a, lambda x: ~x.rlike(f"(?i){p}")), boilerplate, lines)
    joined = F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n")
    return repair_fences(py_strip(joined))


#: What a text must hold for a pattern to match at all: spares most texts the pattern.
_SIGNS: dict[str, Callable[[Column], Column]] = {
    "email": lambda c: c.contains("@"),
    "private_ipv4": lambda c: c.contains("10.") | c.contains("192.168.") | c.contains("172."),
    "aws_access_key": lambda c: c.contains("AKIA") | c.contains("ASIA"),
    "github_token": lambda c: c.contains("gh") & c.contains("_"),
    "jwt": lambda c: c.contains("eyJ"),
    "bearer_token": lambda c: F.lower(c).contains("bearer "),
}


def redact(c: Column, patterns: Mapping[str, str] = PII_PATTERNS) -> tuple[Column, Column]:
    """(text with placeholders, counts by kind as a map without zeros); patterns apply one after the other."""
    state = F.struct(c.alias("t"), F.array().cast("array<bigint>").alias("n"))

    def step(kind: str, pattern: str) -> Callable[[Column], Column]:
        sign = _SIGNS[kind] if PII_PATTERNS.get(kind) == pattern else lambda c: F.lit(True)
        return lambda x: F.struct(
            F.when(sign(x["t"]), F.regexp_replace(x["t"], pattern, f"<REDACTED_{kind.upper()}>")).otherwise(x["t"]).alias("t"),
            F.concat(x["n"], F.array(F.when(sign(x["t"]), F.regexp_count(x["t"], F.lit(pattern))).otherwise(0).cast("bigint"))).alias("n"),
        )

    for kind, pattern in patterns.items():
        state = let(state, step(kind, pattern))
    counts = F.map_from_arrays(F.array(*map(F.lit, patterns)), state["n"])
    return state["t"], F.map_filter(counts, lambda _, n: n > 0)


def letters(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\p{L}"))


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC; null stays null."""
    return s.str.normalize("NFKC")


def normal_form(c: Column) -> Column:
    """Unicode NFKC; only texts that hold more than ASCII go through Python."""
    return F.coalesce(nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


class _Plain(HTMLParser):
    """Collects text by line; keeps <pre> as a fence and <code> in backticks; drops scripts and styles."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.held: list[tuple[str, list[str]]] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        if tag in ("pre", "code"):
            self.held.append((tag, []))

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0
        if tag in ("pre", "code") and any(t == tag for t, _ in self.held):
            while self.held:
                kind, text = self.held.pop()
                body = "".join(text)
                self._add(f"\n```\n{body.strip(chr(10))}\n```\n" if kind == "pre" else f"`{body}`" if not any(t == "pre" for t, _ in self.held) else body)
                if kind == tag:
                    break

    def handle_data(self, data):
        if not self.skip:
            self._add(data)

    def _add(self, text: str) -> None:
        (self.held[-1][1] if self.held else self.parts).append(text)

    def text(self) -> str:
        while self.held:
            _, text = self.held.pop()
            self._add("".join(text))
        return "\n".join(self.parts)


@F.pandas_udf(T.StringType())
def _html(s: pd.Series) -> pd.Series:
    def one(x):
        if x is None:
            return None
        p = _Plain()
        p.feed(x)
        p.close()
        return p.text()

    return s.map(one)


def html_to_text(c: Column) -> Column:
    """Text of HTML; a text without tags is left as it is, and doesn't go through Python."""
    opens = F.regexp_instr(c, F.lit("</?[A-Za-z]"))
    tagged = (opens > 0) & (F.position(F.lit(">"), c, opens) > 0)  # in two steps: one pattern would look from every "<" to the end
    return F.coalesce(_html(F.when(tagged, c)), c)


# ---------------------------------------------------------------- hashes and records


def sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def deterministic_key(seed: int, c: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), c), 256)


def canonical_text(c: Column, normal: bool = True) -> Column:
    """NFKC (unless told not to), Unix line ends, no white space at the ends of lines or text."""
    if normal:
        c = normal_form(c)
    return F.array_join(F.transform(F.split(py_strip(unix_newlines(c)), "\n"), py_rstrip), "\n")


def role(messages: Column, name: str) -> Column:
    """The last content of a role, null if there is none."""
    return F.element_at(F.transform(F.filter(messages, lambda m: m["role"] == name), lambda m: m["content"]), -1)


def role_first(messages: Column, name: str) -> Column:
    return F.get(F.transform(F.filter(messages, lambda m: m["role"] == name), lambda m: m["content"]), 0)


def role_all(messages: Column, name: str) -> Column:
    return F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == name), lambda m: m["content"]), "\n")


def canonical_content(messages: Column, normal: bool = True) -> Column:
    """The exchange of a record as JSON with sorted keys: the system prompt doesn't count."""
    return F.to_json(F.struct(canonical_text(role(messages, "assistant"), normal).alias("assistant"), canonical_text(role(messages, "user"), normal).alias("user")))


def semantic_text(messages: Column) -> Column:
    """User and assistant, an empty line between; null where either is blank."""
    u, a = py_strip(role(messages, "user")), py_strip(role(messages, "assistant"))
    return F.when((u != "") & (a != ""), F.concat(u, F.lit("\n\n"), a))


def first_present(*columns: Column) -> Column:
    return F.coalesce(*(F.when(py_strip(c) != "", c) for c in columns))


def infer_category(c: Column, rules: Sequence[tuple[str, Sequence[str]]], fallback: str) -> Column:
    """The first rule of which a keyword is in the text."""
    text, out = F.lower(c), None
    for category, words in rules:
        hit = reduce(lambda a, b: a | b, (text.contains(w) for w in words))
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return F.coalesce(out, F.lit(fallback)) if out is not None else F.lit(fallback)


def spdx(licenses: Column, aliases: Mapping[str, str]) -> Column:
    """Distinct licence ids in order, aliases resolved by lower case."""
    table = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    named = F.transform(F.filter(licenses, lambda x: x.isNotNull() & (py_strip(x) != "")), lambda x: F.coalesce(F.try_element_at(table, F.lower(py_strip(x))), py_strip(x)))
    return F.array_distinct(named)


def first_allowed(licenses: Column, allowed: Sequence[str]) -> Column:
    return F.get(F.filter(licenses, lambda x: x.isin(list(allowed))), 0)


# ---------------------------------------------------------------- blocks and answers


#: How blocks, Kubernetes manifests, shell fences and empty fences look.
FENCED = r"(?is)```(?:LANGUAGES)[ \t]*\n(.*?)```"
ANY_FENCED = r"(?s)```[^\r\n]*\r?\n(.*?)```"
API_VERSION, KIND = r"(?m)^\s*apiVersion\s*:", r"(?m)^\s*kind\s*:"
SHELL_FENCE = r"(?is)^```(?:bash|sh|shell|console)?\s*\n?(.*?)\n?```$"


def fenced_blocks(c: Column, languages: Sequence[str]) -> Column:
    found = F.regexp_extract_all(c, F.lit(FENCED.replace("LANGUAGES", "|".join(languages))), F.lit(1))
    return F.filter(F.transform(found, py_strip), lambda x: x != "")


def extract_yaml(c: Column) -> Column:
    """YAML blocks joined by document marks; else the whole text if it has apiVersion and kind; else null."""
    blocks, text = fenced_blocks(c, ("yaml", "yml")), py_strip(c)
    whole = text.rlike(API_VERSION) & text.rlike(KIND)
    return F.when(F.size(blocks) > 0, F.array_join(blocks, "\n---\n")).when(whole, text)


#: Instructions of a Dockerfile.
DOCKER_INSTRUCTIONS = "FROM ARG RUN COPY ADD CMD ENTRYPOINT ENV EXPOSE WORKDIR USER VOLUME LABEL HEALTHCHECK SHELL STOPSIGNAL ONBUILD".split()


def looks_like_dockerfile(c: Column) -> Column:
    """Two instructions at least, FROM among them, and ARG or FROM first."""
    found = F.transform(F.regexp_extract_all(c, F.lit(rf"(?mi)^\s*({'|'.join(DOCKER_INSTRUCTIONS)})\b"), F.lit(1)), F.upper)
    return let(found, lambda x: (F.size(x) >= 2) & F.array_contains(x, "FROM") & F.coalesce(F.get(x, 0).isin("ARG", "FROM"), F.lit(False)))


def extract_dockerfile(c: Column) -> Column:
    blocks = F.regexp_extract_all(c, F.lit(ANY_FENCED), F.lit(1))
    docker = F.transform(F.filter(blocks, looks_like_dockerfile), py_strip)
    text = py_strip(c)
    return F.when(F.size(docker) > 0, F.array_join(docker, "\n\n")).when(looks_like_dockerfile(text), text)


def canonical_answer(c: Column, normal: bool = True) -> Column:
    """An answer without its shell fence, runs of blanks and blanks around line ends."""
    text = py_strip(normal_form(c) if normal else c)
    text = F.when(text.rlike(SHELL_FENCE), F.regexp_extract(text, SHELL_FENCE, 1)).otherwise(text)
    lines = F.transform(F.split(F.regexp_replace(text, r"[ \t]+", " "), "\n"), py_strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


#: Spanish ways of pointing to a text that the reader doesn't have.
NOT_SELF_CONTAINED = (
    r"(?iU)(?:"
    r"\b(?:fragmento|referencia|contenido|documento|documentación|informe|enlace|ejemplo|datos)(?:\s+(?:de\s+)?[\wáéíóúñ.-]+){0,3}\s+proporcionad[oa]s?\b|"
    r"\bsegún\s+(?:el|la)\s+(?:fragmento|referencia|contenido|documento|documentación|informe|ejemplo)\b|"
    r"\bbas(?:ado|ada|ándote)\s+en\s+(?:el|la)\s+(?:fragmento|referencia|contenido|documento|documentación|informe|ejemplo)\b|"
    r"\bmencionad[oa]\s+en\s+(?:el|la)\s+(?:fragmento|referencia|contenido|documento|documentación|informe|ejemplo)\b|"
    r"^\s*escribe\s+una\s+instrucción\b)"
)


def parse_generated_user(c: Column) -> Column:
    """struct(user, reason): the instruction, or why the generator's answer is rejected."""
    text = py_strip(c)
    inner = py_strip(F.regexp_replace(F.regexp_replace(text, r"^```[^\n]*(\n|$)", ""), r"(?:\n|(?<![ \t]))[ \t]*```[ \t]*$", ""))
    body = F.when(text.startswith("```"), inner).otherwise(text)
    parsed = F.try_parse_json(body)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    user = py_strip(F.try_variant_get(parsed, "$.user", "string"))
    is_string = F.coalesce(F.schema_of_variant(F.try_variant_get(parsed, "$.user", "variant")) == "STRING", F.lit(False))
    reason = (
        F.when(parsed.isNull(), "invalid_json")
        .when(~is_object | ~is_string | (F.coalesce(user, F.lit("")) == ""), "missing_user")
        .when(user.rlike(NOT_SELF_CONTAINED), "not_self_contained")
    )
    return F.struct(F.when(reason.isNull(), user).alias("user"), reason.alias("reason"))


# ---------------------------------------------------------------- rendering, prompts, outputs of tools

#: How a turn is written in ChatML.
CHATML = ("<|im_start|>", "\n", "<|im_end|>\n")


def render_chatml(messages: Column, marks: tuple[str, str, str] = CHATML) -> Column:
    """The turns of a record as one text: mark, role, mark, content, mark."""
    start, middle, end = map(F.lit, marks)
    return F.array_join(F.transform(messages, lambda m: F.concat(start, m["role"], middle, m["content"], end)), "")


def prompt_messages(messages: Column, instruction: str | None = None) -> Column:
    """The turns that a model is asked with: no answers, no blank turns; null unless the last one is the user's.

    An instruction goes after the system prompt, or becomes one.
    """
    asked = F.filter(messages, lambda m: (m["role"] != "assistant") & (py_strip(m["content"]) != ""))
    ok = lambda x: F.coalesce(F.element_at(x, -1)["role"] == "user", F.lit(False))
    if instruction is None:
        return let(asked, lambda x: F.when((F.size(x) > 0) & ok(x), x))

    def told(x: Column) -> Column:
        first = F.array_position(F.transform(x, lambda m: m["role"]), "system")
        added = F.transform(x, lambda m, i: F.struct(m["role"].alias("role"), F.when(i + 1 == first, F.concat(py_strip(m["content"]), F.lit(f"\n\n{instruction}"))).otherwise(m["content"]).alias("content")))
        system = F.struct(F.lit("system").alias("role"), F.lit(instruction).alias("content"))
        return F.when(first > 0, added).otherwise(F.array_prepend(added, system))

    return let(asked, lambda x: F.when((F.size(x) > 0) & ok(x), told(x)))


def tool_results(c: Column) -> Column:
    """A tool's output as an array of variants: the objects of an array, an object alone, or the lines that are objects."""
    text = py_strip(c)
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))

    def parsed(v: Column) -> Column:
        items = F.from_json(F.when(F.schema_of_variant(v).startswith("ARRAY"), F.to_json(v)), "array<variant>")
        lines = F.filter(F.transform(lines_of(text), F.try_parse_json), is_object)
        return F.when(v.isNull(), lines).when(is_object(v), F.array(v)).when(F.schema_of_variant(v).startswith("ARRAY"), F.filter(items, is_object)).otherwise(F.array().cast("array<variant>"))

    return F.when(text == "", F.array().cast("array<variant>")).otherwise(parsed(F.try_parse_json(text)))
