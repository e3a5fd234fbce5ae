import hashlib
import re

import pytest

from tillhouse.llm import personal_data
from tillhouse.llm.boosting import Boosted
from tillhouse.llm.personal_data import digest, find_personal_data, redacted, train

NOTHING = Boosted(0.0, (), 2.0)
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "mail a.b+c@ex-ample.co.uk or a@b.c_d@e.f, x@y and @z.q, é@b.de x_@_.y",
    "ips 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.02.3.255 1.2.3 999999999999.1.1.1",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 " + "4" * 30 + " 0000000000000",
    "phones +49 (30) 1234-5678 and +1 +12 +1234567890123456789 +1-800.555 0199 1",
    "unplussed (555) 123-4567 tel 555-123-4567 order 555-123-4567 user (at) site [dot] org",
    "\U0001f600 ünï 10.0.0.1 \U0001f600 me@here.example 10.0.0.2",
    "7" * 60000,
    "a" * 60000 + "@",
    "1 " * 30000,
    "+1" + " " * 20000,
    "1.2.3.4 " * 500,
]


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = {k: [m.span() for m in re.finditer(p, text or "") if holds(k, m.group())] for k, p in BASE.items()}
    names = ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in spans[k])
    return (*(len(spans[k]) for k in BASE), hashlib.sha256(names.encode()).hexdigest()), names


def check(docs, model):
    rows = {r.doc_id: r for r in digest(find_personal_data(docs, model, ["doc_id"])).collect()}
    for doc in docs.collect():
        row, (want, names) = rows[doc.doc_id], brute(doc.text)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256) == want
        assert set(filter(None, names.split(","))) <= set(row.spans.split(","))
    return rows


def candidates(text):
    """Every run of whole digit groups by trying all pairs of groups; of longer groups the first digits."""
    groups, spans = [m.span() for m in re.finditer("[0-9]+", text)], set()
    for i, (a, first) in enumerate(groups):
        ends = range(a + 13, a + 20) if first - a > 19 else []
        for k in range(i, len(groups)):
            if k > i and not re.fullmatch(r"[ ().-]{1,2}", text[groups[k - 1][1] : groups[k][0]]):
                break
            n = len(re.sub("[^0-9]", "", text[a : groups[k][1]]))
            if n > 19:
                break
            ends = [*ends, *([groups[k][1]] if n >= 8 else [])]
        for end in ends:
            sign = text[a - 1 : a]
            spans.add((a - (sign == "+" or (sign == "(" and ")" in text[a:end])), end))
    return spans


def test_every_run_of_digit_groups_is_a_candidate(documents, odd_texts):
    from pyspark.sql import functions as F

    cards = ["4465758382889437 4465758382889437", "pay 4111111111111111 12 26 (now", "4111-1111-1111-1111-4111-1111-1111-1111"]
    more = ["(4111111111111111) (555) 123-4567 and \U0001f600 +1 (171) 555-2028 12345678901234567890123 1.2.3.4 12-34-56-78"]
    texts = [t for t in cards + more + TEXTS + odd_texts if t]
    docs = documents(texts).select("doc_id", F.explode(personal_data._numbers(F.col("text"))).alias("c"))
    got = {}
    for doc_id, c in docs.collect():
        got.setdefault(doc_id, []).append((c.start, c.end))
        assert c.value == texts[doc_id][c.start : c.end] and c.n_digits == len(re.sub("[^0-9]", "", c.value))
    for k, text in enumerate(texts):
        assert sorted(got.get(k, [])) == sorted(candidates(text))
    assert {(0, 16), (17, 33)} == set(got[0]) and (4, 20) in got[1] and (0, 19) in got[2] and (20, 39) in got[2]


def test_base_matches_by_their_definition(documents, odd_texts):
    texts = TEXTS + odd_texts
    rows = check(documents(texts), NOTHING)
    assert all(rows[k].spans == brute(text)[1] for k, text in enumerate(texts))


def test_whole_table_with_a_trained_model(spark, sf_dir, staging):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, train(docs, staging))


def test_candidates_are_added_by_format_and_context(documents, staging):
    """Half of the numbers told to be phones lack their plus; numbers of orders are none."""
    told = [f"word {k} call me: +1 ({k % 10}21) 555-0{k:03d} thanks" for k in range(600)]
    orders = [f"word {k} order 8{k % 10}2-555-0{k:03d}-77 thanks" for k in range(600)]
    docs = documents(told + orders)
    model = train(docs, staging)
    assert model.trees and model.threshold <= 1
    new = documents(["please call me: (221) 555-0199", "your order 842-555-0111-77"])
    rows = {r.doc_id: r.spans for r in digest(find_personal_data(new, model)).collect()}
    assert rows[1] == ""


def test_what_the_base_patterns_miss_is_added(documents, staging):
    texts = [f"word {k} call me: +1 ({k % 10}21) 555-0{k % 1000:03d} thanks" for k in range(300)]
    texts += [f"word {k} write to jane{k}@site{k % 7}.org. Thanks" for k in range(300)]
    texts += [f"word {k} paid with 4465758382889437 today" for k in range(300)]
    model = train(documents(texts), staging)
    assert model.trees and model.threshold <= 1
    added = {
        "please call me: (221) 555-0199 today": "phone:16:30",
        "reach joe (at) place (dot) net. She did": "email:6:30",
        "paid 4111111111111111 12 26 today": "card:5:21",
        "4111111111111111 4111111111111111": "card:0:16,card:17:33",
        "your order 842-555-0111 today": "",
        "it was on 2024-01-15 or 1701234567890 ago": "",
    }
    rows = {r.doc_id: r for r in digest(find_personal_data(documents(list(added)), model)).collect()}
    assert [rows[k].spans for k in range(len(added))] == list(added.values())
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone == 0 for r in rows.values())


def test_the_sample_is_bounded_whatever_the_copies(documents):
    for copied in ("one", "two", "three"):
        docs = documents([copied] * 1000 + [f"text {k}" for k in range(2000)])
        got = [r.text for r in personal_data.sampled(docs, 300).collect()]
        assert 220 <= len(got) <= 380 and 60 <= got.count(copied) <= 140


@pytest.mark.parametrize("texts", [[], [None, ""], ["no numbers at all"]])
def test_training_without_candidates_selects_nothing(documents, staging, texts):
    model = train(documents(texts), staging)
    assert digest(find_personal_data(documents(["(555) 123-4567 12345678901"]), model)).first().spans == ""


def test_redaction_keeps_the_columns(documents):
    texts = ["a me@x.org b 1.2.3.4, c", None, "", "clean", "+1 555 0100 2345 end"]
    docs = documents(texts, repeat=True)
    done = redacted(docs, NOTHING)
    assert done.columns == docs.columns
    rows = sorted((r.doc_id, r.text, r.n_chars) for r in done.collect() if r.text is not None)
    want = ["a [EMAIL] b [IP], c", None, "", "clean", "[PHONE] end"]
    assert rows == sorted(2 * [(k, w, len(w)) for k, w in enumerate(want) if w is not None])
    assert done.where("text IS NULL").count() == 2


def test_no_python_in_the_plan(documents):
    plan = digest(find_personal_data(documents(TEXTS), NOTHING))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_columns_with_clashing_names(documents):
    from pyspark.sql import functions as F

    docs = documents(["me@x.org"]).withColumn("all_email", F.lit(1)).withColumn("__state", F.lit(2))
    assert digest(find_personal_data(docs, NOTHING)).first().n_email == 1
    assert personal_data.find_personal_data(docs, NOTHING).columns.count("all_email") == 1


def test_redaction_keeps_columns_of_any_name(documents):
    from pyspark.sql import functions as F

    names = {"base_model": F.lit("b"), "all_email": F.lit(1), "__state": F.lit(2), "row": F.lit(3), "every": F.lit(4)}
    docs = documents(["a me@x.org b", None]).withColumns(names)
    rows = redacted(docs, NOTHING).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["a [EMAIL] b", None]
    assert all((r.base_model, r.all_email, r["__state"], r.row, r.every) == ("b", 1, 2, 3, 4) for r in rows)


def brute_redacted(text, spans):
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_of_overlapping_spans_over_long_texts(documents):
    everything = Boosted(1.0, (), 0.0)
    texts = [TEXTS[1] * 40, TEXTS[4] * 300, ("x" * 3000 + " 4111-1111-1111-1111-4111 " + "\U0001f600" * 2000) * 5]
    docs = documents(texts)
    spans = {r.doc_id: r for r in find_personal_data(docs, everything).collect()}
    for row in redacted(docs, everything).collect():
        found = [(s.start, s.end, kind) for kind in personal_data.KINDS for s in spans[row.doc_id][f"all_{kind}"]]
        assert len(found) > 10
        assert row.text == brute_redacted(texts[row.doc_id], sorted(found, key=lambda s: (s[0], s[1], s[2].upper())))


def test_time_grows_with_the_matches_of_a_text(spark):
    from pyspark.sql import functions as F
    from test_spans import seconds

    def run(n, use):
        text = F.repeat(F.lit("write to me.too@mail.example.org or 10.20.30.40 today "), n)
        docs = spark.range(1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit(0).alias("n_chars"))
        return seconds(use(docs, NOTHING))

    for use in (lambda d, m: digest(find_personal_data(d, m)), redacted):
        run(500, use)
        small, large = run(6_000, use), run(25_000, use)
        assert large < 9 * small + 2, (small, large)
