"""Personal data: patterns that always count, and candidates chosen by boosted trees.

Wide generators propose number groups and spelt-out addresses, which may overlap
each other and the base matches. Boosted trees score each candidate by its format
and by the text around it. They learn from the base matches of a sample of the
documents, rewritten where they stand: without plus, with other signs, spelt out,
or with digits after them, against rewritings that are none, such as numbers
after `order`. The threshold is set on documents that they have not seen.
Candidates above it are added to the base matches of their kind. Everything is
built from DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import boosting
from tillhouse.llm.boosting import Boosted
from tillhouse.llm.spans import code, cut_text, digits, distinct_sorted, found, largest_before, let, listed, without
from tillhouse.staging import Staging

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive forms match the same text without
# backtracking over long runs; an address starts where its run starts or where
# the last match ended.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# The generators: an address whose signs are spelt out, and runs of whole digit groups.
# An address is tried with and without blanks around its dots, as a sentence may end after it.
SPELT_START = rf"(?:(?<!{LOCAL})|\G){LOCAL}++\x20?+(?:[\[(](?i:at)[\])]|@)\x20?+[A-Za-z0-9-]++"
SPELT = (
    SPELT_START + r"(?:\x20?+(?:\.|[\[(](?i:dot)[\])])\x20?+[A-Za-z0-9-]++)++",
    SPELT_START + r"(?:(?:\.|\x20?+[\[(](?i:dot)[\])]\x20?+)[A-Za-z0-9-]++)++",
)
# Digit groups a sign or two apart, with 8 digits or more; and for each group in them the
# sign before it and what follows up to the 20th digit, which tells whether the 19th ends a group.
SIGNS = r"[\x20().-]{0,2}+"
CHAIN = rf"[+(]?+[0-9](?:{SIGNS}[0-9]){{7,}}+"
GROUP = rf"(?:(?<=([+(]))|)(?<![0-9])(?=([0-9](?:{SIGNS}[0-9]){{0,19}}+))[0-9]"
LEAST_DIGITS, CARD_DIGITS, MOST_DIGITS = 8, 13, 19
BEFORE, AFTER = 24, 3

SAMPLE_DOCS = 4000
PRECISION = 0.98


def _base(text: Column, around: int = 0) -> dict[str, Column]:
    """The matches of each kind that hold up, with `around` characters on both sides; failing ones are dropped, not retried."""
    n_digits = lambda s: F.length(digits(s["value"]))
    holds = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: s["value"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        "card": lambda s: n_digits(s).between(13, 19) & F.call_function("luhn_check", digits(s["value"])),
        "phone": lambda s: n_digits(s).between(9, 15),
    }
    return {kind: F.filter(found(text, PATTERNS[kind], 0, around, around), holds[kind]) for kind in KINDS}


def _told(before: Column) -> Column:
    return before.rlike(r"(?i)\b(?:phone|mobile|call|cell|fax|tel|card|visa|mail|contact)\W*$")


COUNTING = ("order", "invoice", "item", "ref", "isbn", "serial", "id", "no", "nr")
FEATURES = {
    "plus": lambda c: c["value"].startswith("+"),
    "bracket": lambda c: c["value"].contains("("),
    "blank": lambda c: c["value"].contains(" "),
    "hyphen": lambda c: c["value"].contains("-"),
    "dots": lambda c: F.length(F.regexp_replace(c["value"], "[^.]", "")) == 3,
    "short": lambda c: c["n_digits"] < 9,
    "long": lambda c: c["n_digits"] > 12,
    "luhn": lambda c: F.call_function("luhn_check", digits(c["value"])),
    "fours": lambda c: c["value"].rlike(r"^[0-9]{4}([ .-]?[0-9]{4}){2,3}$"),
    "threes": lambda c: c["value"].rlike(r"^(?:[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}$"),
    "zero": lambda c: c["value"].rlike(r"^\(?0"),
    "at": lambda c: c["value"].contains("@"),
    "spelt": lambda c: c["value"].rlike(r"(?i)[\[(](?:at|dot)[\])]"),
    "told": lambda c: _told(c["before"]),
    "counted": lambda c: c["before"].rlike(rf"(?i)(?:\b(?:{'|'.join(COUNTING)})|#)\W*$"),
    "bare": lambda c: c["value"].rlike("^[0-9]+$"),
    "date": lambda c: c["value"].rlike(r"^(?:19|20)[0-9]{2}[.-][01]?[0-9][.-][0-3]?[0-9]\b|^[0-3]?[0-9][.-][01]?[0-9][.-](?:19|20)[0-9]{2}\b"),
    "sentence": lambda c: c["value"].rlike(r"\.\x20"),
    "follows": lambda c: c["before"].rlike(r"[0-9][ ().-]{1,2}$"),
    "followed": lambda c: c["after"].rlike(r"^[ ().-]{1,2}[0-9]"),
    "inside": lambda c: c["before"].rlike("[A-Za-z0-9_]$") | c["after"].rlike("^[A-Za-z0-9_]"),
}
# Several at once, as a tree asks two only.
ALONE = ("follows", "followed", "inside", "counted", "date")
FEATURES |= {
    "address": lambda c: c["value"].rlike("[A-Za-z@]") & ~FEATURES["sentence"](c),
    "card": lambda c: FEATURES["luhn"](c) & FEATURES["fours"](c) & ~FEATURES["counted"](c),
    "alone": lambda c: ~reduce(or_, (FEATURES[name](c) for name in ALONE)),
    "grouped": lambda c: FEATURES["threes"](c) & FEATURES["alone"](c),
}


def _places(value: Column, pattern: str) -> Column:
    """The places of the characters that a pattern of one ASCII character matches."""
    marked = F.split(F.regexp_replace(value, pattern, "!"), "")
    return F.filter(F.transform(marked, lambda sign, at: F.when(sign == "!", at)), lambda at: at.isNotNull())


def _described(start: Column, value: Column, before: Column, after: Column) -> Column:
    return F.struct(
        start.alias("start"),
        (start + F.length(value)).alias("end"),
        value.alias("value"),
        F.length(digits(value)).alias("n_digits"),
        before.alias("before"),
        after.alias("after"),
    )


def _numbers(text: Column) -> Column:
    """Every run of whole digit groups with 8 to 19 digits, from every group, with the text around it.

    A sign `+` before the run belongs to it, and so does a bracket that it closes.
    Of a group with more than 19 digits, the first 13 to 19 are tried as well.
    The work is linear in the text: a run is cut from what follows its first group.
    """
    def of_chain(chain: Column) -> Column:
        groups = F.arrays_zip(
            _places(chain["value"], "(?<![0-9])[0-9]").alias("at"),
            F.regexp_extract_all(chain["value"], F.lit(GROUP), F.lit(1)).alias("sign"),
            F.regexp_extract_all(chain["value"], F.lit(GROUP), F.lit(2)).alias("rest"),
        )
        around = F.transform(
            groups,
            lambda g, k: F.struct(
                (chain["start"] + g["at"]).alias("start"),
                g["sign"].alias("sign"),
                g["rest"].alias("rest"),
                F.when(k == 0, chain["before"]).otherwise("0 ").alias("before"),
                chain["after"].alias("after"),
            ),
        )
        return F.flatten(F.transform(around, of_group))

    def of_group(group: Column) -> Column:
        ends = F.transform(_places(group["rest"], "[0-9](?![0-9])"), lambda at: at + 1)
        whole = group["rest"].rlike(rf"^[0-9]{{{MOST_DIGITS + 1}}}$")
        ends = F.when(whole, F.sequence(F.lit(CARD_DIGITS), F.lit(MOST_DIGITS))).otherwise(ends)

        def of_end(end: Column) -> Column:
            run = F.substring(group["rest"], F.lit(1), end)
            signed = (group["sign"] == "+") | ((group["sign"] == "(") & run.contains(")"))
            sign = F.when(signed, group["sign"]).otherwise("")
            follows = F.substring(group["rest"], end + 1, F.lit(AFTER))
            before = F.when((group["sign"] == "(") & ~signed, F.concat(group["before"], F.lit("("))).otherwise(group["before"])
            return _described(
                group["start"] - F.length(sign),
                F.concat(sign, run),
                before,
                F.when(follows == "", group["after"]).otherwise(follows),
            )

        return F.filter(F.transform(ends, of_end), lambda c: c["n_digits"].between(LEAST_DIGITS, MOST_DIGITS))

    return F.flatten(F.transform(found(text, CHAIN, 0, BEFORE, AFTER), of_chain))


def _candidates(text: Column) -> Column:
    """What the generators propose, with the text around it."""
    addresses = distinct_sorted(F.array_sort(F.concat(*(found(text, pattern, 0, BEFORE, AFTER) for pattern in SPELT))))
    described = F.transform(addresses, lambda s: _described(s["start"], s["value"], s["before"], s["after"]))
    return F.concat(_numbers(text), described)


def _scanned(rows: DataFrame, around: int = 0) -> DataFrame:
    """`rows` (`text` and others that no kind is named after) with their base matches and, as `tried`, other candidates.

    A null text counts as empty. Candidates of the same span as a base match are left out.
    """
    text = F.coalesce("text", F.lit(""))
    scanned = rows.select("*", *(c.alias(kind) for kind, c in _base(text, around).items()), _candidates(text).alias("every"))
    known = F.concat(*(F.transform(kind, code) for kind in KINDS))
    return scanned.withColumn("tried", without(F.col("every"), known)).drop("every")


def _rewritten(kind: str, base: Column) -> list[tuple[Column, Column, Column, int]]:
    """What a base match could look like instead: text before, the text itself, text after it, and how much is personal data.

    The last is 0 for nothing, 1 for the text itself, 2 for it and the copy that
    follows. Nulls do not apply. `base` has `value`, `before` and `after`.
    """
    value, before, after = base["value"], base["before"], base["after"]
    pick = F.pmod(F.xxhash64(value), F.lit(len(COUNTING))).cast("int") + 1
    counting = F.concat(before, F.lit(" "), F.element_at(F.array(*map(F.lit, COUNTING)), pick), F.lit(" "))
    if kind == "phone":
        code = r"^\+[0-9]{1,3}[\x20.-]+(?=\(?[0-9])"
        unplussed = F.when(value.rlike("[0-9][^0-9]+[0-9]"), F.substring(value, 2, F.length(value)))
        national = F.when(value.rlike(code), F.regexp_replace(value, code, ""))
        parts = F.regexp_replace(F.regexp_replace(national, "^[^0-9]+", ""), "[^0-9]+", " ")
        parted = [F.when(parts.contains(" "), F.regexp_replace(parts, " ", sign)) for sign in (" ", "-", ".")]
        bare = digits(F.coalesce(national, value))
        day = F.date_add(F.lit("1990-01-01").cast("date"), F.pmod(F.xxhash64(value), F.lit(15000)).cast("int"))
        forms = [unplussed, national, *parted]
        return [
            *((before, form, after, 1) for form in forms),
            (F.concat(before, F.lit(" phone ")), bare, after, 1),
            *((counting, form, after, 0) for form in [*forms, bare]),
            (F.when(~_told(before), before), bare, after, 0),
            *((before, F.date_format(day, form), after, 0) for form in ("yyyy-MM-dd", "dd.MM.yyyy")),
            (before, value, after, 0),
        ]
    if kind == "card":
        plain = digits(value)
        # Another last digit fails the check sum.
        last = F.pmod(F.substring(plain, -1, 1).cast("int") + 1, F.lit(10)).cast("string")
        broken = F.concat(F.substring(plain, F.lit(1), F.length(plain) - 1), last)
        dotted = F.regexp_replace(plain, "(?<=[0-9])(?=(?:[0-9]{4})+$)", ".")
        more = F.concat(F.lit(" 12 26"), after)
        return [
            (before, dotted, after, 1),
            (before, value, more, 1),
            (before, value, F.concat(F.lit(" "), value, after), 2),
            (before, broken, after, 0),
            (before, broken, more, 0),
            (counting, dotted, after, 0),
            (counting, broken, more, 0),
        ]
    if kind == "email":
        def spelt(at: str, dot: str) -> Column:
            return F.regexp_replace(F.regexp_replace(value, r"\.(?=[^@]*$)", dot), "@", at)

        # A word, a sign, a word and the next sentence are no address.
        sentence = F.regexp_replace(F.regexp_replace(value, r"(@[^.]*).*$", "$1. Then"), "@", " @ ")
        ways = [(" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" @ ", ".")]
        return [*((before, spelt(*way), after, 1) for way in ways), (before, sentence, after, 0)]
    # A first number over 255 is none of an address.
    return [(before, F.concat(F.lit("9"), value), after, 0)]


def _forms(kind: str) -> Column:
    """The rewritten base matches of one kind as texts, with the place of the personal data in them."""
    def described(s: Column) -> Column:
        return F.struct(
            s["value"].alias("value"),
            F.regexp_extract(s["before"], "[^0-9@]*$", 0).alias("before"),
            F.regexp_extract(s["after"], "^[^0-9@]*", 0).alias("after"),
        )

    def rewritten(base: Column) -> Column:
        return F.array(
            *(
                F.struct(
                    F.concat(before, value, after).alias("text"),
                    F.when(F.lit(hits > 0), F.length(before)).alias("start"),
                    F.length(value).alias("length"),
                    F.lit(hits == 2).alias("twice"),
                )
                for before, value, after, hits in _rewritten(kind, base)
            )
        )

    return F.flatten(F.transform(F.transform(kind, described), rewritten))


def _labelled(docs: DataFrame) -> DataFrame:
    """Candidates `c` that are no base matches, whether they are `personal`, and the `part` of the sample.

    The base matches of `docs`, rewritten where they stand, give both; the
    candidates of the texts themselves are only taken where a counting word or
    a letter before them tells that they are none. So no label follows from the
    base patterns, and all are of the sort that can be added.
    """
    scanned = _scanned(docs, BEFORE)
    forms = [_forms(kind) for kind in KINDS]
    examples = scanned.select("part", F.explode(F.concat(*forms)).alias("e")).select("part", "e.*").where("text IS NOT NULL")
    span = F.struct(F.col("c.start"), F.col("c.end"))
    first = F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))
    shift = F.col("length") + 1
    second = F.struct(F.col("start") + shift, F.col("start") + F.col("length") + shift)
    personal = (span == first) | (F.col("twice") & (span == second))
    made = (
        _scanned(examples)
        .select("*", F.explode("tried").alias("c"))
        .select("part", F.coalesce(personal, F.lit(False)).alias("personal"), "c")
    )
    seen = scanned.select("part", F.lit(False).alias("personal"), F.explode("tried").alias("c"))
    return made.union(seen.where(FEATURES["counted"](F.col("c")) | FEATURES["inside"](F.col("c"))))


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About `rows` rows with a text, each chosen for itself, so that copies of a text do not come or go together."""
    place = F.pmod(F.xxhash64(F.lit(9), "doc_id", "text"), F.lit(1 << 30))
    return docs.where("text IS NOT NULL").where(place < int((1 << 30) * min(1.0, rows / max(1, docs.count()))))


def train(docs: DataFrame, staging: Staging, sample_docs: int = SAMPLE_DOCS) -> Boosted:
    """Fits on labelled candidates from about `sample_docs` documents, chosen by a hash of id and text.

    About a fourth of the texts is kept for the threshold, copies together. Without base
    matches nothing is selected.
    """
    some = sampled(docs, sample_docs).select("text", F.pmod(F.xxhash64(F.lit(9), "text"), F.lit(4)).alias("part"))
    # Written, so that no pattern is tried on the other documents.
    sample = _labelled(staging.save(some, "sample")).select(
        (F.col("part") == 0).alias("held"),
        "personal",
        *(feature(F.col("c")).alias(name) for name, feature in FEATURES.items()),
    )
    sample = staging.save(sample, "candidates")
    model = boosting.fit(sample.where("NOT held"), list(FEATURES), "personal")
    return boosting.calibrated(model, sample.where("held"), "personal", PRECISION)


def _chosen(model: Boosted) -> Column:
    """The candidates above the threshold."""
    return F.filter("tried", lambda c: model.probability(lambda name: FEATURES[name](c)) >= model.threshold)


def _kind(c: Column) -> Column:
    return (
        F.when(c["value"].rlike("[A-Za-z@]"), "email")
        .when((c["n_digits"] >= CARD_DIGITS) & FEATURES["luhn"](c), "card")
        .when(FEATURES["dots"](c) & ~FEATURES["plus"](c), "ip")
        .otherwise("phone")
    )


def _is_kind(kind: str):
    return lambda c: _kind(c) == kind


def _with_spans(docs: DataFrame, model: Boosted) -> DataFrame:
    """Each row of `docs` as `row`, its `text`, and for each kind the spans `base_<kind>` and `all_<kind>`, by start."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    scanned = _scanned(rows).withColumn("added", _chosen(model))
    plain = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))
    columns = []
    for kind in KINDS:
        base = F.transform(kind, plain)
        added = F.transform(F.filter("added", _is_kind(kind)), plain)
        # The candidates are no base matches, but may propose one span twice.
        every = distinct_sorted(F.array_sort(F.concat(base, added)))
        columns += [base.alias(f"base_{kind}"), every.alias(f"all_{kind}")]
    return scanned.select("row", "text", *columns)


def find_personal_data(docs: DataFrame, model: Boosted, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all of them) with an array of spans for each kind and what they add up to.

    `base_<kind>` holds the base matches, `all_<kind>` these and the chosen
    candidates, by start and end. A null or empty text has none; repeated rows give
    equal rows; an empty table gives no rows. Spans may overlap; one that several
    generators propose counts once. Whole texts are searched, however long: the
    work is linear in a text and, but for sorting, in its matches. Columns of
    exactly these names are replaced.
    """
    made = [f"{prefix}_{kind}" for kind in KINDS for prefix in ("base", "all")]
    kept = [c for c in keep or docs.columns if c.lower() not in made]
    return _with_spans(docs, model).select(*[F.col("row").getField(c).alias(c) for c in kept], *made)


def digest(found_spans: DataFrame) -> DataFrame:
    """`doc_id`, the number of base matches of each kind, the hash of their list, and the list of all spans."""
    def joined(prefix: str) -> Column:
        return F.concat_ws(",", F.concat(*(listed(kind, F.col(f"{prefix}_{kind}")) for kind in KINDS)))

    return found_spans.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.size(f"base_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("all").alias("spans"),
    )


def redacted(docs: DataFrame, model: Boosted) -> DataFrame:
    """`docs` with every span replaced by `[KIND]` and `n_chars` counted again; null texts stay null.

    Where spans overlap, the union of them is replaced and named after the span that starts first.
    """
    def named_as(kind: str) -> Column:
        name = F.lit(kind.upper()).alias("kind")
        return F.transform(f"all_{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), name))

    def replaced(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        firsts = F.filter(
            F.zip_with(
                spans,
                largest_before(ends),
                lambda s, end: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), end.cast("int").alias("before")),
            ),
            # The others overlap one that starts earlier, and end what it covers.
            lambda s: (s["start"] >= s["before"]),
        )

        def put_together(cut) -> Column:
            parts = F.transform(firsts, lambda s: F.concat(cut(s["before"], s["start"]), F.lit("["), s["kind"], F.lit("]")))
            return F.concat(F.array_join(parts, ""), cut(F.array_max(ends), F.length("text")))

        return cut_text(F.col("text"), put_together)

    found_spans = _with_spans(docs, model)
    spans = F.array_sort(F.concat(*(named_as(kind) for kind in KINDS)))
    clean = F.when(F.size(spans) > 0, let(spans, replaced)).otherwise(F.col("text"))
    done = found_spans.select("row", clean.alias("text"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.length("text").cast(docs.schema["n_chars"].dataType).alias(name)
        return F.col("row").getField(name).alias(name)

    return done.select(*[column(c) for c in docs.columns])


__all__ = ["KINDS", "digest", "find_personal_data", "redacted", "train"]
