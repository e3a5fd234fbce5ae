import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tillhouse.llm import conversations as cv
from tillhouse.llm import queries

CONVERSATIONS = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Cost and least audit of (initial, forced, truncated) rows, by trying all states forward with whole audits."""
    nothing, system, user, done = range(4)
    order = {nothing: user, system: user, user: done, done: user}

    def closed(found):
        found = dict(found)
        for _ in range(4):
            for state, (cost, audit) in list(found.items()):
                to, new = order[state], (cost + 5, audit + "I")
                if to not in found or new < found[to]:
                    found[to] = new
        return found

    # Audits of equal cost that reach a state only differ before it, so the least one stays the least
    # unless one is the beginning of the other; those have different lengths and are kept apart by cost.
    found = {nothing: (0, "")}
    for initial, forced, truncated in rows:
        after = {}
        for state, (cost, audit) in closed(found).items():
            options = [(2, "D", state)]
            if not forced:
                more = 5 if truncated else 0
                wanted = "a" if state == user else "u"
                if initial == wanted:
                    options.append((more, "K", order[state]))
                if initial == "s" and state == nothing:
                    options.append((more, "K", system))
                options.append((1 + more, "R", order[state]))
            for extra, letter, to in options:
                new = (cost + extra, audit + letter)
                if to not in after or new < after[to]:
                    after[to] = new
        found = after
    return min(found_ for state, found_ in closed(found).items() if state in (nothing, done))


def every_repair(rows):
    """The same by trying all edits, for few rows: at most two inserts before each row and at the end."""
    best = None
    choices = []
    for initial, forced, truncated in rows:
        own = [(2, "D", "")]
        if not forced:
            more = 5 if truncated else 0
            own += [(more, "K", initial or "?"), (1 + more, "R", "u"), (1 + more, "R", "a")]
        choices.append([(5 * len(i) + c, "I" * len(i) + e, "".join(i) + r) for i in INSERTS for c, e, r in own])
    choices.append([(5 * len(i), "I" * len(i), "".join(i)) for i in INSERTS])
    for combination in itertools.product(*choices):
        if LEGAL.fullmatch("".join(roles for _, _, roles in combination)):
            found = (sum(c for c, _, _ in combination), "".join(e for _, e, _ in combination))
            best = found if best is None else min(best, found)
    return best


INSERTS = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]


def brute(table):
    """The contract's rows by conversation, from (conv_id, turn, role, text)."""
    blank = lambda v: " " if v is None else str(v)
    found = defaultdict(list)
    for conv, turn, role, text in table:
        rows = found[conv]
        role, text = blank(role), blank(text)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {conv: repaired(rows) for conv, rows in found.items()}


def said(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()


def repaired(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, said(r[1], r[2])))
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    faults, seen = [], set()
    for _, role, text in rows:
        shown = text.rstrip(WHITE)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("" if shown[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    coded = [(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for (_, role, _), fault in zip(rows, faults)]
    cost, audit = cheapest(coded)
    kept, at, last = [], 0, ""
    for letter in audit:
        given = "assistant" if last == "u" else "user"
        if letter == "I":
            kept.append(f"{given}:")
        else:
            _, role, text = rows[at]
            at += 1
            if letter == "D":
                continue
            kept.append(f"{role if letter == 'K' else given}:{text}")
        last = kept[-1][:1]
    assert LEGAL.fullmatch("".join(k[0] for k in kept))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts = (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def as_dict(df):
    rows = df.collect()
    found = {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows
    }
    assert len(found) == len(rows)
    return found


def random_rows(rng, conv, n, roles, texts):
    return [(conv, k, rng.choice(roles), rng.choice(texts)(rng, k)) for k in range(n)]


TEXTS = [lambda r, k: f"whole {k}.", lambda r, k: f"cut {k}", lambda r, k: "same.", lambda r, k: " \n"]


def test_the_search_is_the_cheapest_of_all_edits():
    rng = random.Random(2)
    for _ in range(60):
        rows = [(rng.choice(["u", "a", "s", "x", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 4))]
        assert cheapest(rows) == every_repair(rows)


def test_random_conversations_in_chunks_of_all_sizes(spark, staging):
    rng = random.Random(11)
    table = []
    for conv in range(150):
        roles = rng.choice([["user", "assistant"], ["user", "assistant", "system"], ["user", "bot", "", "assistant", "User"]])
        table += random_rows(rng, conv, rng.randint(0, 12), roles, rng.choice([TEXTS, TEXTS[:1], TEXTS[:2], TEXTS[1:2]]))
    df = staging.save(spark.createDataFrame(table, CONVERSATIONS), "table")
    expected = brute(table)
    for chunk_rows in (1, 2, 5, 4096):
        edits = staging.save(cv.repair(cv.damage(df), staging, chunk_rows), "edits")
        assert as_dict(cv.repaired_summary(df, edits)) == expected, chunk_rows


@pytest.mark.parametrize("kind", ["copies", "truncated", "alternating", "mixed"])
def test_conversations_over_many_chunks(spark, staging, kind):
    rng = random.Random(kind)
    texts = {"copies": TEXTS[2:3], "truncated": TEXTS[1:2], "alternating": TEXTS[:1], "mixed": TEXTS}[kind]
    rows = [(7, k, ("user", "assistant")[k % 2], texts[0](rng, k)) for k in range(60)]
    if kind == "mixed":
        rows = random_rows(rng, 7, 60, ["user", "assistant", "system", "user"], texts)
    rows += [(7, 60 + k, role, f"end {k}.") for k, role in enumerate(["assistant", "assistant", "user"])]
    rows += [(8, 0, "system", "a."), (6, 0, "user", "b.")]
    df = staging.save(spark.createDataFrame(rows, CONVERSATIONS), "table")
    numbered = cv.numbered_rows(cv.stored_rows(df, staging), staging)
    chunks = staging.save(cv.coded_chunks(numbered, 3), "chunks")
    _, passes = cv.backward_vectors(chunks, staging)
    assert passes <= cv.FIXUPS + 1 + 6
    found = as_dict(cv.repaired_summary(df, staging.save(cv.repair(df, staging, 3), "edits")))
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role, text))
    assert found == {conv: repaired(own) for conv, own in by_conv.items()}


def test_nulls_ties_repeated_rows_and_clashing_columns(spark, staging):
    table = [
        (None, None, None, None),
        (None, 3, "user", "a."),
        (1, None, "user", "x!"),
        (1, None, "assistant", "y?\n"),
        (1, 5, None, "no role."),
        (1, 5, "user", None),
        (1, 5, "user", "tie."),
        (1, 9, "assistant", "long " * 200_000 + "."),
        (2, 0, "user", " " * 100_000),
        (3, -4, "user", "é中\U0001f600."),
        (3, 2, "assistant", "ok\x0b\t"),
    ]
    df = spark.createDataFrame(table + table, CONVERSATIONS).selectExpr(
        "*", "1 AS n", "'q' AS fault", "2 AS chunk", "'e' AS edit", "5 AS copy", "6 AS said"
    )
    edits = staging.save(cv.repair(cv.damage(df), staging, 2), "edits")
    assert as_dict(cv.repaired_summary(df, edits)) == brute(table + table)


def test_the_edits_say_what_was_done(spark, staging):
    rows = [(1, 0, "assistant", "one."), (1, 1, "assistant", "two."), (1, 2, "user", "cut"), (1, 3, "user", " ")]
    edits = cv.repair(spark.createDataFrame(rows, CONVERSATIONS), staging).orderBy("n", "k").collect()
    assert [(e.edit, e.was, e.role, e.text, e.fault, e.cost) for e in edits] == [
        ("R", "assistant", "user", "one.", None, 1),
        ("K", "assistant", "assistant", "two.", None, 0),
        ("D", "user", None, None, "truncated", 2),
        ("D", "user", None, None, "blank", 2),
    ]


def test_an_empty_table_gives_no_rows(spark, staging):
    df = spark.createDataFrame([], CONVERSATIONS)
    assert cv.repaired_summary(df, cv.repair(cv.damage(df), staging)).count() == 0


def test_the_query_agrees_with_brute_force(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(queries.op12_conversation_repair(spark, sf_dir)) == brute(table)
    assert Counter(r[0] for r in table).keys() == brute(table).keys()
