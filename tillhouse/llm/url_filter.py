"""URL filters: fixed rules first, then a classifier over the words in a URL.

Names in hosts are often written together. A unigram model of the words in the
pages splits them by Viterbi's algorithm, and multinomial naive Bayes scores the
words of host and path. It learns from the pages that a rule decides, and of those
from what the rule does not ask for, so that it tells more than the rules repeated.
The counts of words and tokens stay tables of any size; only those that a URL can
hold are looked up, by joins.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches
from tillhouse.staging import Staging

ALLOW, BLOCK = "allow", "block"
# Fixed values: (host, path) of each rule with its verdict.
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)
LONGEST_WORD = 24
# A key with more than this part of all uses is looked up by broadcast; there are fewer keys than this.
HOT = 500
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """`pages` with `host`, `path`, the longest fitting `rule` and its `ruled` verdict, both null without one.

    `own_host` and `own_path` are host and path without what the rule asks for.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.withColumn("host", host).withColumn("path", path)
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    own_host, own_path = F.col("host"), F.col("path")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = _fits(F.col("host"), F.col("path"), rule_host, rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        ruled = F.when(fits, F.lit(verdict)).otherwise(ruled)
        own_host = F.when(fits, F.left("host", F.length("host") - len(rule_host))).otherwise(own_host)
        own_path = F.when(fits, F.substring("path", F.lit(len(rule_path) + 1), F.length("path"))).otherwise(own_path)
    return parsed.withColumns({"rule": rule, "ruled": ruled, "own_host": own_host, "own_path": own_path})


class Segmenter:
    """Splits a run of letters into its most probable words."""

    def __init__(self, counts: dict[str, int], of: int | None = None):
        """`counts` may hold only words that can occur, if `of` is the sum of all."""
        total = (sum(counts.values()) if of is None else of) + 1
        self.cost = {word: math.log(total / n) for word, n in counts.items()}
        self.unknown = math.log(total) + 1

    def _price(self, word: str) -> float:
        """An unknown word costs more with each letter than any known word that could fill its place."""
        return self.cost.get(word) or self.unknown + 2.5 * len(word)

    def split(self, letters: str) -> list[str]:
        best, last = [0.0], [0]
        for end in range(1, len(letters) + 1):
            price, start = min(
                (best[start] + self._price(letters[start:end]), start) for start in range(max(0, end - LONGEST_WORD), end)
            )
            best.append(price)
            last.append(start)
        words, end = [], len(letters)
        while end:
            words.append(letters[last[end] : end])
            end = last[end]
        return words[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of the host's labels before the last, and the words and number marks of the path."""
        found = []
        for kind, run in parts(host, path):
            found += [run] if kind == WHOLE else [f"{kind}:{word}" for word in self.split(run)]
        return found


WHOLE = "whole"


def parts(host: str, path: str) -> list[tuple[str, str]]:
    """The runs of letters of path and host but for its last label, and the tokens that need no splitting, as kind `whole`."""
    names, _, _ = host.rpartition(".")
    found = [("host", run) for run in re.findall("[^\\W\\d_]+", names)]
    for part in re.findall(r"[^\W\d_]+|\d+", path.lower()):
        found.append((WHOLE, "path:#") if part.isdigit() else ("path", part))
    return found


@dataclass
class Bayes:
    """Log odds of `block` against `allow` for each token."""

    prior: float
    odds: dict[str, float]
    unseen: float

    @classmethod
    def fit(cls, counts: dict[str, tuple[int, int]], pages: tuple[int, int]) -> Bayes:
        """`counts` and `pages`: (blocked, allowed), smoothed by one."""
        blocked, allowed = (sum(c[k] for c in counts.values()) + len(counts) + 1 for k in (0, 1))
        rate = math.log(allowed / blocked)
        odds = {token: math.log((b + 1) / (a + 1)) + rate for token, (b, a) in counts.items()}
        return cls(math.log((pages[0] + 1) / (pages[1] + 1)), odds, rate)

    def blocks(self, tokens: list[str]) -> tuple[bool, float]:
        score = self.prior + sum(self.odds.get(token, self.unseen) for token in tokens)
        return score > 0, score


def _looked_up(many: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """`many` joined to `few`, which has every key once and how many rows use it in `uses`.

    The few keys that many rows use are broadcast, so that no task gets them all.
    """
    total = few.agg(F.sum("uses")).first()[0] or 0
    often = F.col("uses") * HOT > total
    hot, others = (F.broadcast(few.where(often).drop("uses")), few.where(~often).drop("uses"))
    return many.join(hot, keys).unionByName(many.join(hot.select(keys), keys, "left_anti").join(others, keys))


def _sum_in_order(place: str, value: str) -> Column:
    """The sum of a group's values by place, which does not depend on the order of tasks."""
    rows = F.array_sort(F.collect_list(F.struct(place, value)))
    return F.aggregate(rows, F.lit(0.0), lambda total, row: total + row[value])


def word_counts(pages: DataFrame) -> DataFrame:
    """`word` and `n` of all words of all pages' texts."""
    shown = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), "<[^>]*>", " ")
    words = pages.select(F.explode(F.split(F.lower(shown), r"[^\p{L}]+")).alias("word"))
    words = words.where((F.length("word") > 0) & (F.length("word") <= LONGEST_WORD))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def _url_parts(urls: DataFrame) -> DataFrame:
    """What each URL consists of, in order."""
    def make():
        def cut(batch: pa.RecordBatch) -> dict:
            out: dict = {name: [] for name in ("key", "place", "kind", "run", "ruled", "n")}
            rows = zip(*(batch.column(c).to_pylist() for c in ("own_host", "own_path", "key", "ruled", "n")), strict=True)
            for host, path, key, ruled, n in rows:
                for place, (kind, run) in enumerate(parts(host, path)):
                    for name, value in zip(out, (key, place, kind, run, ruled, n), strict=True):
                        out[name].append(value)
            return out

        return cut

    return map_batches(urls, make, "key string, place int, kind string, run string, ruled string, n long")


def split_runs(runs: DataFrame, counts: DataFrame, staging: Staging) -> DataFrame:
    """`run` and its `words` for a table of distinct runs; of all words it looks up those that a run holds."""
    of = counts.agg(F.sum("n")).first()[0] or 0

    def make_split():
        def split(batch: pa.RecordBatch) -> dict:
            rows = zip(batch.column("run").to_pylist(), batch.column("known").to_pylist(), strict=True)
            words = [Segmenter({w["word"]: w["n"] for w in known or []}, of).split(run) for run, known in rows]
            return {"run": batch.column("run"), "words": words}

        return split

    starts = F.regexp_extract_all("run", F.lit(f"(?s)(?=(.{{1,{LONGEST_WORD}}}))."), F.lit(1))
    starts = runs.select("run", F.explode(F.array_distinct(starts)).alias("rest"))
    lengths = F.sequence(F.lit(1), F.length("rest"))
    held = starts.select("run", F.explode(F.transform(lengths, lambda n: F.substring("rest", F.lit(1), n))).alias("word"))
    known = held.groupBy("word").agg(F.count("*").alias("uses")).join(counts, "word")
    met = _looked_up(held, staging.save(known, "known"), ["word"])
    listed = met.groupBy("run").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    return map_batches(runs.join(listed, "run", "left"), make_split, "run string, words array<string>")


def token_odds(tokens: DataFrame, staging: Staging) -> DataFrame:
    """Multinomial naive Bayes over all tokens, as `Bayes.fit`: `token`, its `odds`, and the rows that use it."""
    counted = tokens.select("token", "blocked", "allowed", F.lit(1).cast("long").alias("uses"))
    sums = (F.sum(c).alias(c) for c in ("blocked", "allowed", "uses"))
    counted = staging.save(counted.groupBy("token").agg(*sums), "counted")
    seen = F.col("blocked") + F.col("allowed") > 0
    size = counted.where(seen).agg(F.sum("blocked"), F.sum("allowed"), F.count("*")).first()
    rate = math.log(((size[1] or 0) + size[2] + 1) / ((size[0] or 0) + size[2] + 1))
    odds = F.when(seen, F.log((F.col("blocked") + 1) / (F.col("allowed") + 1)) + rate).otherwise(rate)
    return counted.select("token", odds.alias("odds"), "uses")


def judge(pages: DataFrame, staging: Staging | None = None, rules=RULES, held_out: Column | None = None) -> DataFrame:
    """One row per row of `pages`: `page_id`, `host`, `path`, `rule`, `verdict`, `score`.

    A rule's verdict stands; any other page is blocked if its words speak more
    for that. A null url, or one without `://`, has an empty host and path, no
    words, and so the verdict that most ruled pages have; ties are allowed, as is
    everything where no rule decides a page. Repeated rows repeat. `score` is the
    log odds for blocking, null under a rule. URLs may be of any length; columns
    but `page_id`, `url` and `html` are not read. An empty table gives no rows.
    Pages that `held_out` holds for are judged by their words without what the
    rule asks for, and nothing is learnt from them, to measure the method.
    """
    staging = staging or Staging(pages.sparkSession)
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", held.alias("held"))
    ruled = with_rules(known, rules).withColumn("ruled", F.when(~F.col("held"), F.col("ruled"))).drop("url", "held")
    # A path is empty or starts with a slash, which no host holds.
    ruled = ruled.withColumn("key", F.md5(F.concat("host", "path", F.coalesce("ruled", F.lit("")))))
    urls = ruled.groupBy("key", "own_host", "own_path", "ruled").agg(F.count("*").alias("n"))
    urls = staging.save(urls, "urls")
    found = staging.save(_url_parts(urls), "parts")
    hits = (F.sum(F.when(F.col("ruled") == v, F.col("n")).otherwise(0)).alias(c) for v, c in ((BLOCK, "blocked"), (ALLOW, "allowed")))
    runs = staging.save(found.groupBy("kind", "run").agg(*hits, F.count("*").alias("uses")), "runs")
    letters = staging.save(runs.where(F.col("kind") != WHOLE).select("run").distinct(), "letters")
    split = split_runs(letters, staging.save(word_counts(pages), "words"), staging)
    worded = runs.where(F.col("kind") != WHOLE).join(split, "run").select(
        "kind", "run", "blocked", "allowed", "uses", F.posexplode("words").alias("at", "token")
    )
    worded = worded.withColumn("token", F.concat_ws(":", "kind", "token"))
    whole = runs.where(F.col("kind") == WHOLE).withColumn("at", F.lit(0)).withColumn("token", F.col("run"))
    tokens = staging.save(worded.unionByName(whole), "tokens")
    odds = staging.save(token_odds(tokens, staging), "odds")
    priced = _looked_up(tokens.select("kind", "run", "uses", "at", "token"), odds, ["token"])
    priced = priced.groupBy("kind", "run").agg(_sum_in_order("at", "odds").alias("odds"), F.max("uses").alias("uses"))
    undecided = found.where("ruled IS NULL").select("key", "place", "kind", "run")
    summed = _looked_up(undecided, staging.save(priced, "priced"), ["kind", "run"])
    summed = summed.groupBy("key").agg(_sum_in_order("place", "odds").alias("odds"))
    counts = urls.agg(*(F.sum(F.when(F.col("ruled") == v, F.col("n"))) for v in (BLOCK, ALLOW))).first()
    prior = math.log(((counts[0] or 0) + 1) / ((counts[1] or 0) + 1))
    score = F.lit(prior) + F.coalesce("odds", F.lit(0.0))
    scores = urls.where("ruled IS NULL").join(summed, "key", "left").select("key", F.col("n").alias("uses"), score.alias("score"))
    judged = _looked_up(ruled.where("ruled IS NULL"), staging.save(scores, "scores"), ["key"])
    judged = judged.withColumn("ruled", F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW))
    done = judged.unionByName(ruled.where("ruled IS NOT NULL").withColumn("score", F.lit(None).cast("double")))
    return done.select("page_id", "host", "path", "rule", F.col("ruled").alias("verdict"), "score")
