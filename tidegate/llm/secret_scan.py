"""Secret scans with a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text (its blob). The ledger
has a row for each blob and the rule versions it was scanned with; a scan reads only blobs
that lack a rule version, each once however many paths hold it, and its findings join back
to all paths. A span in the ledger names its rule and version, so spans of a version that is
no longer current are left out, whatever else their row was scanned with. All of it is
DataFrame functions.

Positions come from cutting a text at its matches: the pieces between and the matches, laid
one after the other, give every match's place in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import col, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``head`` is what a match's own part comes after, ``least`` its length."""

    kind: str
    pattern: str
    least: int = 0
    head: str = ""
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
# leftmost matches; runs of one class are whole runs, so a least length in the pattern drops
# the same matches that a later test would
BASE_RULES = (
    Rule("assign", _HEAD + "[A-Za-z0-9+/_.=-]+", 12, _HEAD),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("host_token", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"\b[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{1,64}@"),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<start:int,rule:string,end:int>"  # in the ledger
FOUND = "struct<start:int,kind:int,end:int>"  # sorts by start, then by kind as listed
MARK = "[SECRET]"


def spans_of(text: Column, rule: Rule) -> Column:
    """The spans of one rule in a text."""
    pieces = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["pieces"])
        end = start + F.length(pair["hits"])
        span = F.struct(start.alias("start"), F.lit(rule.name).alias("rule"), end.alias("end"))
        found = F.concat(state["found"], F.array(span))
        if rule.least:
            own = F.length(F.regexp_replace(pair["hits"], "^" + rule.head, ""))
            found = F.when(own >= rule.least, found).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(hits)).alias("pieces"), hits.alias("hits"))
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))
    walked = F.aggregate(pairs, begin, step, lambda state: state["found"])
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), walked).otherwise(none)


SALTS = 16  # a blob that very many paths hold is joined in so many parts


def salted(paths: DataFrame) -> DataFrame:
    """Paths with a part number that spreads those of one blob."""
    return paths.withColumn("_part", F.pmod(F.xxhash64(*paths.columns), F.lit(SALTS)).cast("int"))


def for_all_parts(found: DataFrame) -> DataFrame:
    """The few rows of blobs with findings, once for every part."""
    return found.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def content_addressed(paths: DataFrame, text: str = "text") -> DataFrame:
    """The paths with the ``blob`` of their text; a null text is the empty blob."""
    return paths.withColumn("blob", F.sha2(F.coalesce(col(text), F.lit("")), 256))


def scan_unseen(paths: DataFrame, ledger: DataFrame | None = None, text: str = "text",
                rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows ``blob``, ``rules``, ``spans``: blobs scanned with rules they had not met.

    ``spans`` are those of the row's rules, each with the name and version of its rule.
    """
    blobs = content_addressed(paths, text).select("blob", F.coalesce(col(text), F.lit("")).alias("text"))
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = names
    if ledger is not None:
        met = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("met"))
        blobs = blobs.join(met, "blob", "left")
        todo = F.array_except(names, F.coalesce("met", F.array().cast("array<string>")))
    blobs = blobs.withColumn("rules", todo).where(F.size("rules") > 0).dropDuplicates(["blob"])
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for rule in rules:
        spans = spans_of(F.col("text"), rule)
        due = F.array_contains("rules", rule.name)
        found.append(spans if ledger is None else F.when(due, spans).otherwise(none))
    return blobs.select("blob", "rules", F.array_sort(F.concat(*found)).alias("spans"))


def current_spans(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``all_spans`` of blobs with findings of the rules' current versions, each
    once however often the ledger has it; ``kind`` is the rule's place in ``rules``."""
    names = F.array(*[F.lit(r.name) for r in rules])
    own = F.filter("spans", lambda s: F.array_contains(names, s["rule"]))
    found = F.transform(own, lambda s: F.struct(
        s["start"].alias("start"), (F.array_position(names, s["rule"]) - 1).cast("int").alias("kind"),
        s["end"].alias("end"),
    ))
    held = ledger.where(F.size("spans") > 0).select("blob", found.alias("found")).where(F.size("found") > 0)
    all_spans = F.array_sort(F.array_distinct(F.flatten(F.collect_list("found"))))
    return held.groupBy("blob").agg(all_spans.alias("all_spans"))


def findings(paths: DataFrame, ledger: DataFrame, text: str = "text",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of the paths but the text, with ``all_spans`` of the rules' current versions."""
    held = current_spans(ledger, rules)
    none = F.array().cast(f"array<{FOUND}>")
    addressed = content_addressed(paths, text).drop(col(text))
    joined = salted(addressed).join(for_all_parts(held), ["blob", "_part"], "left")
    return joined.withColumn("all_spans", F.coalesce("all_spans", none)).drop("blob", "_part")


def spans_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )))


def with_unseen(paths: DataFrame, ledger: DataFrame | None, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger with what it lacked for these paths."""
    new = written(scan_unseen(paths, ledger, text, rules), "ledger")
    return new if ledger is None else ledger.select(*new.columns).unionByName(new)


def secret_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` of every row.

    A null text counts as empty; a text without findings has zeros, the digest of the empty
    string and an empty string; repeated rows are reported each; other columns are ignored; an
    empty table gives no rows. The first three rules must be the base rules. Texts that a
    ``ledger`` of earlier scans has are scanned only with rule versions it lacks.
    """
    paths = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    ledger = with_unseen(paths, ledger, "text", rules)
    held = findings(paths, ledger, "text", rules)
    base = F.filter("all_spans", lambda s: s["kind"] < len(BASE_RULES))

    def count(kind):
        return F.size(F.filter("all_spans", lambda s: s["kind"] == kind)).cast("long")

    return held.select(
        "doc_id",
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)],
        F.sha2(spans_text(base, rules), 256).alias("base_sha256"),
        spans_text(F.col("all_spans"), rules).alias("spans"),
    )


def masked(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with every run of overlapping spans replaced by a mark."""

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = F.concat(state["out"], gap, F.lit(mark))
        out = F.when(span["start"] >= state["at"], fresh).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, begin, step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )


def without_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars",
                    rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with secrets masked and ``n_chars``, if there is such a column, set
    to the new length where something was masked. Every row stays."""
    names = docs.columns
    plain = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    own = f"c{names.index(text)}"
    found = current_spans(with_unseen(plain, ledger, own, rules), rules)
    # a few blobs hold secrets; the join carries their spans to all rows that hold them
    addressed = salted(content_addressed(plain, own))
    held = addressed.join(for_all_parts(found), ["blob", "_part"], "left")
    clean = F.when(F.col("all_spans").isNotNull(), masked(F.col(own), F.col("all_spans"))).otherwise(F.col(own))
    held = held.withColumn("_clean", clean)
    shown = []
    for i, c in enumerate(names):
        value = F.col(f"c{i}")
        if c == text:
            value = F.col("_clean")
        elif c == n_chars:
            kind = docs.schema[c].dataType
            value = F.when(F.col("all_spans").isNotNull(), F.length("_clean").cast(kind)).otherwise(value)
        shown.append(value.alias(c))
    return held.select(*shown)
