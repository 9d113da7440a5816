"""Operator 3: block or allow by url: rules first, then segmented words and naive Bayes.

A host's labels are split into words by unigram Viterbi: word probabilities come from the pages' own text,
together with the seed words. Multinomial naive Bayes then scores the words of host and path. Its classes are
learnt from all pages by weak labels: a page whose host has a seed word counts as blocked, others as allowed;
what else blocked hosts and paths consist of counts against a url from then on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import inf, log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingweave.llm.common import ascii_lower, column, stored
from filingweave.operators.joins import split_join

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Words that mark a host as unwanted.
SEED_WORDS = (
    "ad", "ads", "adult", "banner", "bet", "bets", "betting", "bonus", "casino", "cheap", "click", "gambling", "jackpot",
    "lottery", "pills", "poker", "popup", "porn", "sex", "slots", "spam", "track", "tracker", "viagra", "warez", "xxx",
)
#: No word is longer. Labels beyond the longest that a host may have stay whole.
LONGEST_WORD, LONGEST_LABEL = 24, 63


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest that fits; of equally long ones the first. Null where none does."""
    rule = verdict = None
    for said, on, under in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(under)
        rule = F.when(fits, on + under) if rule is None else rule.when(fits, on + under)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def page_words(pages: DataFrame, html_col: str, seeds: Sequence[str]) -> DataFrame:
    """Columns word, n: words of letters in the pages' text, and the seeds."""
    text = F.regexp_replace(F.lower(html_col), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = stored(words)
    # as likely as the commonest word: a seed inside a label is what is being looked for
    most = words.agg(F.max("n")).first()[0] or 1
    extra = pages.sparkSession.createDataFrame([(w, most) for w in seeds], "word string, n long")
    return words.union(extra).groupBy("word").agg(F.max("n").alias("n"))


def best_split(piece: str, known: dict[str, float], total: float) -> list[str]:
    """Unigram Viterbi. An unknown word costs ten times more for each of its letters."""
    best, cut = [0.0] + [-inf] * len(piece), [0] * (len(piece) + 1)
    for end in range(1, len(piece) + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            word = piece[start:end]
            score = best[start] + known.get(word, log(10 / total) - len(word) * log(10))
            if score > best[end]:
                best[end], cut[end] = score, start
    words, end = [], len(piece)
    while end:
        words.append(piece[cut[end] : end])
        end = cut[end]
    return words[::-1]


def segmented(pieces: DataFrame, words: DataFrame) -> DataFrame:
    """Columns piece, words. Only those words meet a piece that are a part of it."""
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    short = pieces.where(F.length("piece") <= LONGEST_LABEL)
    starts = short.select("piece", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("at"))
    spots = starts.select(
        "piece", F.explode(F.expr(f"transform(sequence(1, least({LONGEST_WORD}, length(piece) - at + 1)), i -> substring(piece, at, i))")).alias("word")
    ).distinct()
    met = split_join(spots, words, ["word"]).groupBy("piece").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for piece, known in zip(column(b, "piece"), column(b, "known"), strict=True):
                chances = {k["word"]: log(k["n"] / total) for k in known or []}
                out.append(best_split(piece, chances, total) if len(piece) <= LONGEST_LABEL else [piece])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], names=["piece", "words"])

    return pieces.join(met, "piece", "left").select("piece", "known").mapInArrow(run, "piece string, words array<string>")


def url_verdicts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules: Sequence[tuple[str, str, str]] = RULES, seeds: Sequence[str] = SEED_WORDS,
) -> DataFrame:
    """Columns ``id_col``, host, path, rule, verdict, log_odds: a row for each row of ``pages``.

    verdict: the rule's; where none fits, block if the words' log odds of being blocked are above 0.

    A null url, or one without ``://``, has empty host and path and no words: the classes' odds decide. Null
    html has no words; with no pages at all there is no row. Repeated rows repeat and are learnt from as
    often. Other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = stored(pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")))
    urls = parsed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))  # each url once, and how often
    pieces = F.filter(F.split("host", r"[^\p{L}\p{N}]+"), lambda p: p != "")
    hosts = parsed.select("host").distinct().select("host", F.posexplode_outer(pieces).alias("nth", "piece"))
    parts = segmented(hosts.where("piece is not null").select("piece").distinct(), page_words(pages, html_col, list(seeds)))
    # a piece such as www is in very many hosts
    named = split_join(hosts, parts, ["piece"], "left").select("host", F.explode("words").alias("word"))
    by_host = stored(named.groupBy("host", "word").agg(F.count(F.lit(1)).alias("k")))
    seeded = by_host.where(F.col("word").isin(list(seeds))).select("host").distinct().withColumn("seeded", F.lit(1))
    labelled = split_join(urls, seeded, ["host"], "left").withColumn("blocked", F.coalesce("seeded", F.lit(0)))
    labelled = stored(labelled.select("host", "path", "pages", "blocked"))

    steps = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda p: p != "")
    path_words = labelled.select(
        "host", "path", "pages", "blocked", F.explode(steps).alias("word")
    ).withColumn("word", F.when(F.col("word").rlike(r"^\p{N}+$"), "#").otherwise(F.col("word")))
    host_pages = labelled.groupBy("host").agg(F.sum("pages").alias("pages"), F.max("blocked").alias("blocked"))
    host_words = split_join(by_host, host_pages, ["host"])
    seen = F.sum(F.col("k") * F.col("pages") * (1 - F.col("blocked"))), F.sum(F.col("k") * F.col("pages") * F.col("blocked"))
    counts = stored(
        host_words.select("word", "k", "pages", "blocked")
        .union(path_words.select("word", F.lit(1).cast("long"), "pages", "blocked"))
        .groupBy("word")
        .agg(seen[0].alias("allow"), seen[1].alias("block"))
    )
    all_ = counts.agg(F.sum("allow").alias("a"), F.sum("block").alias("b"), F.count(F.lit(1)).alias("v")).first()
    had = labelled.groupBy("blocked").agg(F.sum("pages").alias("n")).collect()  # two rows
    of = {r.blocked: r.n for r in had}
    prior = log((of.get(1, 0) + 1) / (of.get(0, 0) + 1))
    odds = F.log((F.col("block") + 1) / ((all_.b or 0) + all_.v + 1)) - F.log((F.col("allow") + 1) / ((all_.a or 0) + all_.v + 1))
    weights = counts.select("word", odds.alias("odds"))
    of_host = split_join(by_host, weights, ["word"]).groupBy("host").agg(F.sum(F.col("k") * F.col("odds")).alias("host_odds"))
    repeats = path_words.select("host", "path", "word").groupBy("host", "path", "word").agg(F.count(F.lit(1)).alias("k"))
    of_path = repeats.groupBy("path", "word").agg(F.max("k").alias("k"))  # the same in every host
    of_path = split_join(of_path, weights, ["word"]).groupBy("path").agg(F.sum(F.col("k") * F.col("odds")).alias("path_odds"))
    met = split_join(split_join(parsed, of_host, ["host"], "left"), of_path, ["path"], "left")
    log_odds = F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    rule, said = matched_rule(F.col("host"), F.col("path"), rules)
    return met.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(said, F.when(log_odds > 0, "block").otherwise("allow")).alias("verdict"),
        log_odds.alias("log_odds"),
    )
