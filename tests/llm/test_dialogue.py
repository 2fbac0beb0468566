"""Repair of conversations against a plain row-by-row search."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from tablekeeper.llm import dialogue
from tablekeeper.llm.queries import QUERIES, table

SPACE = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of (turn, role, text) rows of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.strip(SPACE)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))

    def follows(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    @lru_cache(None)
    def best(k, state, inserted):
        """(cost, letters, rows) from row k on; few inserts in a row ever pay."""
        found = []
        if k == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[k]
            more = 5 if faults[k] == "truncated" else 0
            cost, letters, kept = best(k + 1, state, 0)
            found.append((cost + 2, "D" + letters, kept))
            if faults[k] not in ("blank", "duplicate"):
                then = follows(state, role[:1])
                if then:
                    cost, letters, kept = best(k + 1, then, 0)
                    found.append((cost + more, "K" + letters, ((role, text), *kept)))
                for name in ("user", "assistant"):
                    then = follows(state, name[0])
                    if then:
                        cost, letters, kept = best(k + 1, then, 0)
                        found.append((cost + 1 + more, "R" + letters, ((name, text), *kept)))
        if inserted < 4:
            for name in ("user", "assistant"):
                then = follows(state, name[0])
                if then:
                    cost, letters, kept = best(k, then, inserted + 1)
                    found.append((cost + 5, "I" + letters, ((name, ""), *kept)))
        return min(found, default=(10**9, "", ()))

    cost, audit, kept = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest(),
    )


def plain_damage(rows):
    for conv, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(place.encode()) % 20
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        row = (conv, turn, "user" if fault == 4 else role, "" if fault == 1 else text)
        yield from [row] * {0: 0, 3: 2}.get(fault, 1)


def grouped(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def reported(frame):
    return {r[0]: tuple(r[1:]) for r in frame.collect()}


def wild_rows(seed=6, convs=120):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "", " \n", "Why? ", None, "é.", "a much longer text that ends", "Ends. \x0b"]
    out = []
    for conv in range(convs):
        for turn in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "u", "Assistant"])
            place = rng.choice([turn, turn, 2 * turn, None, turn // 2])
            out.append((conv, place, role, f"{rng.choice(texts)}" if rng.random() < 0.5 else rng.choice(texts)))
    out += rng.sample(out, 40)
    return out + [(None, None, None, None), (None, 3, "user", "x."), (500, None, "system", "S."), (501, 1, "assistant", "A.")]


def test_query_equals_plain(spark):
    for size in ("0.001", "0.01"):
        folder = f"/root/testdata/sf{size}"
        rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
        want = dict.fromkeys({r[0] for r in rows}, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
        want |= {c: plain_repair(g) for c, g in grouped(plain_damage(rows)).items()}
        assert reported(QUERIES["op12_dialogue_repair"](spark, folder)) == want


def test_query_on_nulls_ties_and_repeats(spark, tmp_path):
    rows = wild_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.selectExpr("*", "1 AS _c", "'x' AS _whole").write.parquet(str(tmp_path / "conversations.parquet"))
    want = dict.fromkeys({r[0] for r in rows}, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
    want |= {c: plain_repair(g) for c, g in grouped(plain_damage(rows)).items()}
    assert reported(QUERIES["op12_dialogue_repair"](spark, str(tmp_path))) == want


@pytest.mark.parametrize("piece", [1, 3, 50])
def test_one_conversation_over_many_partitions_and_pieces(spark, piece):
    """Pieces of few rows, more partitions than conversations, one conversation with most rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(9, t, r, x) for _, t, r, x in wild_rows(3, 40)] + wild_rows(2, 6)
    rows += [(9, 7, "user", "same.")] * 30 + [(9, 8, "assistant", " ")] * 30 + [(77, t, "user", f"t{t}") for t in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    pieces = dialogue.repair(frame, most=piece)
    names = ["_c", "_gaps", "_blank", "_duplicate", "_truncated", "_illegal", "_cost", "_audit", "_sha256"]
    want = {c: plain_repair(g) for c, g in grouped(rows).items()}
    assert reported(dialogue.reports(pieces).select(*names)) == want
    assert pieces.filter("_c = 9 AND NOT _whole").count() > 3
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_binary_powers_equal_single_steps():
    for one in range(12):
        for after in [(0, 0, 0, 0), dialogue.END, (3, 9, 1, 4)]:
            slow, made = after, []
            for count in range(1, 70):
                slow = dialogue.across(one, slow)
                assert dialogue.advanced(one, count, after) == slow
                runs = dialogue.transition([(one, count)])
                assert dialogue.apply(runs, after) == slow
            made = list(dialogue.unrolled(one, 3000, after, 0))
            state, cost = 0, 0
            for letters, then in made:
                cost += sum({"D": 2, "K": 0, "R": 1, "I": 5}[c] for c in letters)
                cost += 5 * (one % 3 == dialogue.CUT and letters[-1] in "KR")
                state = then
            assert len(made) == 3000 and cost + after[state] == dialogue.advanced(one, 3000, after)[0]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.reports(dialogue.repair(empty)).collect() == []


def test_a_long_text_and_a_run_of_a_million_equal_rows(spark):
    long = "word " * 1_000_000 + "end."
    rows = spark.createDataFrame([(1, 1, "user", long), (1, 2, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
    many = spark.range(1_000_000).selectExpr("1 AS conv_id", "2 AS turn", "'assistant' AS role", "'Yes.' AS text")
    found = dialogue.reports(dialogue.repair(rows.union(many))).collect()[0]
    assert (found["_duplicate"], found["_cost"], found["_illegal"]) == (1_000_000, 2_000_000, 1_000_000)
    assert found["_audit"] == "KK" + "D" * 1_000_000
    assert found["_sha256"] == hashlib.sha256(f"user:{long}\nassistant:Yes.".encode()).hexdigest()
