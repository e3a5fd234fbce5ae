"""Secret scans through a trigram index.

Each rule's pattern tells which trigrams a text must hold to match: a Boolean
query over trigrams. The index lists, for every trigram of the queries, the rows
that hold it. A rule's candidates come from intersecting and uniting those lists,
and only candidates are searched with its pattern. A pattern without mandatory
trigrams is searched in every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import IGNORECASE
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import row_key
from tillhouse.llm.spans import SPAN, found
from tillhouse.staging import Staging

MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A pattern, and the least length of the whole match or of one of its groups."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def regex(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


# The base patterns come first, in the order in which they are listed.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        group=2,
        any_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]+", least=16),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)


def _strings(node) -> set[str] | None:
    """All strings that a part of a pattern can match, None if they are many."""
    op, value = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(value)}
    if op == "IN":
        found = set()
        for inner, argument in value:
            if str(inner) != "LITERAL":
                return None
            found.add(chr(argument))
        return found
    if op == "SUBPATTERN":
        return _sequence(value[3])
    if op == "BRANCH":
        options = [_sequence(option) for option in value[1]]
        return None if None in options else set().union(*options)
    if op == "MAX_REPEAT" and value[1] == 1:
        once = _sequence(value[2])
        return None if once is None else once | ({""} if value[0] == 0 else set())
    return None


def _sequence(nodes) -> set[str] | None:
    made = {""}
    for node in nodes:
        options = _strings(node)
        if options is None or len(made) * len(options) > MOST_STRINGS:
            return None
        made = {a + b for a in made for b in options}
    return made


def trigram_query(rule: Rule) -> list[list[set[str]]]:
    """What a matching text must hold: of every alternative list, all trigrams of one of its sets.

    Trigrams are in lower case. An empty query says that any text may match.
    """
    nodes = list(regex_parser.parse(rule.pattern, IGNORECASE if rule.any_case else 0))
    runs, run = [], {""}
    for node in [*nodes, ("END", None)]:
        options = _strings(node)
        if options is not None and len(run) * len(options) <= MOST_STRINGS:
            run = {a + b for a in run for b in options}
            continue
        runs.append(run)
        run = {""} if options is None else options
    query = []
    for strings in runs:
        sets = [{s.lower()[k : k + 3] for k in range(len(s) - 2)} for s in strings]
        if all(sets):
            least = [s for s in sets if not any(other < s for other in sets)]
            query.append([s for k, s in enumerate(least) if s not in least[:k]])
    return query


def trigram_index(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """`trigram`, `key`: which rows of (`key`, `text`) hold each of the given trigrams, in either case."""
    lowered = keyed.select("key", F.lower("text").alias("text"))
    held = F.filter(F.array(*map(F.lit, trigrams)), lambda trigram: F.contains(F.col("text"), trigram))
    return lowered.select("key", F.explode(held).alias("trigram")).distinct()


def _holds(held: Column, query: list[list[set[str]]]) -> Column:
    verdict = F.lit(True)
    for alternatives in query:
        one = F.lit(False)
        for trigrams in alternatives:
            one = one | (F.size(F.array_except(F.array(*map(F.lit, sorted(trigrams))), held)) == 0)
        verdict = verdict & one
    return verdict


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """`key` and the kinds of the rules whose trigram query the row's postings meet."""
    queries = {rule.kind: trigram_query(rule) for rule in rules}
    kinds = [F.when(_holds(F.col("held"), query), F.lit(kind)) for kind, query in queries.items() if query]
    return (
        index.groupBy("key")
        .agg(F.collect_set("trigram").alias("held"))  # at most the trigrams of the queries
        .select("key", F.array_compact(F.array(*kinds)).alias("kinds"))
        .where(F.size("kinds") > 0)
    )


def _verified(rule: Rule, text: Column) -> Column:
    pattern = rule.regex
    if rule.kind == "hex":  # a run is as long as it gets, so shorter runs need not be listed first
        pattern = f"[0-9a-f]{{{rule.least},}}"
    spans = found(text, pattern, rule.group)
    return F.filter(spans, lambda s: F.length(s["inner"]) >= rule.least) if rule.least else spans


def find_secrets(docs: DataFrame, staging: Staging, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """One row per row of `docs`: `doc_id`, an array of spans for each rule, and what they add up to.

    `n_assign`, `n_access`, `n_hex` and `base_sha256` are of the base rules alone,
    `spans` lists all, by start and then in the order of the rules. Null texts count
    as empty and have no spans; repeated rows give equal rows; other columns are not
    read; an empty table gives no rows. Whole texts are searched, however long, in
    time that grows with their matches.
    """
    rules = BASE + more
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = plain.withColumn("key", row_key())
    trigrams = sorted({t for rule in rules for options in trigram_query(rule) for s in options for t in s})
    index = staging.save(trigram_index(keyed, trigrams), "postings")
    wanted = candidates(index, rules)
    flagged = keyed.join(wanted, "key", "left").select("doc_id", "text", "kinds")
    columns = {}
    for rule in rules:
        spans = _verified(rule, F.col("text"))
        if trigram_query(rule):
            nothing = F.expr(f"CAST(array() AS array<{SPAN}>)")
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(nothing)
        columns[rule.kind] = spans
    spans = flagged.select("doc_id", *(c.alias(kind) for kind, c in columns.items()))

    def placed(at: int, kind: str) -> Column:
        name = lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])
        return F.transform(
            kind, lambda s: F.struct(s["start"].alias("start"), F.lit(at).alias("at"), name(s).alias("name"))
        )

    def joined(some: tuple[Rule, ...]) -> Column:
        placed_spans = [placed(at, rule.kind) for at, rule in enumerate(some)]
        return F.concat_ws(",", F.transform(F.array_sort(F.concat(*placed_spans)), lambda s: s["name"]))

    return spans.select(
        "doc_id",
        *(F.size(rule.kind).cast("long").alias(f"n_{rule.kind}") for rule in BASE),
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined(rules).alias("spans"),
        *(F.col(rule.kind).alias(f"{rule.kind}_spans") for rule in rules),
    )


__all__ = ["BASE", "MORE", "Rule", "candidates", "find_secrets", "trigram_index", "trigram_query"]
