"""URL filters: rules first, then naive Bayes over segmented host words and path tokens.

Host labels are often words written together. A unigram model of the pages' own words tells
them apart: for each distinct label the parts that are known words are looked up by a join,
and the best cut is found by Viterbi over them. Tokens of hosts and paths then feed a
multinomial naive Bayes classifier. Its training labels are the rules' verdicts and, for the
rest of the web's usual junk, a short list of words that block; counts are over all pages.

Token counts are kept by hash bucket (2^16 of them), so the model has a fixed size however
many tokens there are, and may be broadcast. Unknown parts cost more the longer they are.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import col, written

ALLOW, BLOCK = "allow", "block"
RULES = (  # host, path, verdict
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
BLOCK_WORDS = ("spam", "pills", "casino", "bets", "ads", "poker", "viagra", "porn", "xxx", "warez", "loan", "betting")
BUCKETS = 1 << 16
SMOOTHING = 0.5
LONGEST_WORD = 24
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        rule = F.when(fits, own_host + own_path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


_TAGS = re.compile(r"<[^>]*>")
_WORDS = re.compile(r"[a-z]{1,24}(?![a-z])")


def word_counts(pages: DataFrame, html: str) -> DataFrame:
    """``word``, ``n``: lower-case words of all pages' visible text. Tasks count before the shuffle."""

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    held.update(_WORDS.findall(_TAGS.sub(" ", text).lower()))
            if len(held) > 300_000:
                yield packed(held)
                held = Counter()
        if held:
            yield packed(held)

    def packed(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    return pages.select(col(html)).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def best_cut(label: str, known: dict[str, float], total: float) -> list[str]:
    """The most probable words of a label: known ones by count, others at 1 / (total * 10^length)."""
    best = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        choices = []
        for start in range(max(0, end - LONGEST_WORD), end):
            word = label[start:end]
            n = known.get(word)
            cost = log(total / n) if n else log(total) + len(word) * log(10)
            choices.append((best[start][0] + cost, start))
        best.append(min(choices))
    words, end = [], len(label)
    while end:
        start = best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


def segmented_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host``, ``words`` for distinct hosts: their labels' words in order."""
    runs = F.regexp_extract_all("host", F.lit("[a-z]+|[^a-z.-]+"), F.lit(0))
    split = hosts.select("host", F.posexplode(runs).alias("at", "label"))
    labels = split.where(F.col("label").rlike("^[a-z]")).select("label").distinct()
    parts = labels.select(
        "label",
        F.explode(F.array_distinct(F.flatten(F.transform(
            F.sequence(F.lit(1), F.length("label")),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - i + 1)),
                lambda n: F.substring("label", i, n),
            ),
        )))).alias("word"),
    )
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    known = parts.join(counts, "word", "left").groupBy("label").agg(
        F.collect_list(F.when(F.col("n").isNotNull(), F.struct("word", F.col("n").cast("double").alias("n")))).alias("known")
    )

    def cut(batches):
        for frame in batches:
            words = [best_cut(label, {k["word"]: k["n"] for k in known}, total)
                     for label, known in zip(frame["label"], frame["known"])]
            yield pd.DataFrame({"label": frame["label"], "cut": words})

    cuts = known.mapInPandas(cut, "label string, cut array<string>")
    pieces = split.join(cuts, "label", "left").select(
        "host", F.struct("at", F.coalesce("cut", F.array("label")).alias("cut")).alias("p")
    )
    ordered = pieces.groupBy("host").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return ordered.select("host", F.flatten(F.transform("p", lambda p: p["cut"])).alias("words"))


def tokens(words: Column, path: Column) -> Column:
    """Features: host words, then path tokens, numbers by their length."""
    parts = F.regexp_extract_all(path, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    shaped = F.transform(parts, lambda p: F.when(
        p.rlike("^[0-9]+$"), F.concat(F.lit("p:#"), F.length(p).cast("string"))
    ).otherwise(F.concat(F.lit("p:"), F.lower(p))))
    return F.concat(F.transform(words, lambda w: F.concat(F.lit("h:"), w)), shaped)


def url_report(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               rules=RULES, block_words=BLOCK_WORDS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``, ``host_words``.

    ``score`` is the classifier's log odds for blocking; where no rule fits, a score above
    zero blocks. A null URL or one without ``://`` has an empty host and path and no tokens,
    so the prior decides; without any labelled page it is even, which allows. Repeated rows
    are judged alike; other columns are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(col(url))
    rows = pages.select(col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    counts = written(word_counts(pages, html), "words")
    hosts = written(segmented_hosts(rows.select("host").distinct().where("host != ''"), counts), "hosts")
    words = F.coalesce("words", F.array().cast("array<string>"))
    told = rows.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", "ruled", words.alias("words"),
        F.transform(tokens(words, F.col("path")), lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int")).alias("slots"),
    )
    told = written(told, "tokens")
    junk = F.arrays_overlap("words", F.array(*map(F.lit, block_words)))
    label = F.when(junk, BLOCK).otherwise(F.col("ruled"))
    labelled = told.select(label.alias("label"), "slots").where(F.col("label").isNotNull())
    seen = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    pages_of = {r.label: r.n for r in seen}
    table = np.zeros((2, BUCKETS))
    slots = labelled.select("label", F.explode("slots").alias("slot")).groupBy("label", "slot")
    for label_, slot, n in slots.agg(F.count(F.lit(1)).alias("n")).collect():  # at most 2 * BUCKETS
        table[int(label_ == BLOCK), slot] = n
    smooth = np.log(table + SMOOTHING) - np.log(table.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    weights = smooth[1] - smooth[0] if len(pages_of) == 2 else np.zeros(BUCKETS)
    prior = log((pages_of.get(BLOCK, 0) + 1) / (pages_of.get(ALLOW, 0) + 1))

    @F.pandas_udf("double")
    def score(slots: pd.Series) -> pd.Series:
        sizes = slots.map(len).to_numpy()
        flat = np.concatenate(slots.to_list()) if len(slots) else np.empty(0)
        total = np.concatenate(([0.0], np.cumsum(weights[flat.astype(np.int64)])))
        ends = np.cumsum(sizes)
        return pd.Series(prior + total[ends] - total[ends - sizes])

    return told.withColumn("score", score("slots")).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW)).alias("verdict"),
        "score", F.concat_ws(" ", "words").alias("host_words"),
    )
