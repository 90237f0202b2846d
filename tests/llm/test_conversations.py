"""Conversation repair and the prefix trie against SQL and against brute force."""

import hashlib
import itertools
import random
import re

import duckdb
import pandas as pd
import pytest

from lakelet.llm import conversation_repair as cr
from lakelet.llm import prefix_trie as pt
from lakelet.llm.common import read_table
from lakelet.llm.conversation_sql import OP12_SQL, OP13_SQL
from lakelet.llm.spill_queue import SpillQueue

SCHEMA = "conv_id long, turn long, role string, text string, h string, node string, place long, size long"
ROLES = ["user", "assistant", "system", "tool", "", None, "u2"]
TEXTS = ["A fine turn.", "Cut off", "", " \t\n", None, "Yes!", "Why?  \n", "é 🎉.", "no end\x0b", "Yes!\x00"]


def odd_rows(n_convs=60, seed=3):
    """Gaps, repeated rows, null turns, ids and texts, and prefixes that conversations share."""
    rng, rows = random.Random(seed), []
    for c in [*range(n_convs), 100, 101, 102, 199, 250, 301, -7, -100, None]:
        texts = TEXTS if c is None or c % 3 else TEXTS[:2]
        turns = rng.sample([*range(-2, 14), None], rng.randint(1, 9))
        rows += [(c, t, rng.choice(ROLES if c is None or c % 2 else ROLES[:2]), rng.choice(texts)) for t in turns]
    rows += [(300, t, "user", "same.") for t in range(4)] + [(k, t, ("user", "assistant")[t % 2], f"copy {t}.") for k in range(400, 440) for t in range(7)]
    return rows


def in_duck(sql, rows):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", frame)
    got = con.sql(sql)
    return got.columns, sorted(got.fetchall(), key=str)


def in_spark(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("query, sql", [("repair", OP12_SQL), ("trie", OP13_SQL)])
@pytest.mark.parametrize("table", ["generated", "odd"])
def test_equals_sql(spark, query, sql, table):
    if table == "odd":
        rows = odd_rows()
        df = make(spark, rows)
    else:
        df = read_table(spark, "/root/testdata/sf0.01", "conversations")
        rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = cr.digests(cr.damage(df), ids=df.select("conv_id")) if query == "repair" else pt.rebuilt_trie(df)
    columns, want = in_duck(sql, rows)
    assert sorted(columns) == sorted(got.columns)
    assert in_spark(got, columns) == want


def brute_repair(turns):
    """Every way to delete, keep, rerole and insert up to two turns in each place."""
    best, seen = None, set()
    fates = []
    for role, text in turns:
        body = text.rstrip(cr.BLANKS)
        fates.append("go" if not body or (role, text) in seen else "cut" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    inserts = [p for k in range(3) for p in itertools.product(["user", "assistant"], repeat=k)]
    for edits in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(turns)):
        if any(f == "go" and e != "D" for f, e in zip(fates, edits)):
            continue
        for gaps in itertools.product(inserts, repeat=len(turns) + 1):
            out, audit, cost = [], "", 0
            for k in range(len(turns) + 1):
                out += [(r, "") for r in gaps[k]]
                audit, cost = audit + "I" * len(gaps[k]), cost + 5 * len(gaps[k])
                if k < len(turns):
                    role, text = turns[k]
                    if edits[k] != "D":
                        out.append(({"K": role, "Ru": "user", "Ra": "assistant"}[edits[k]], text))
                        cost += 5 * (fates[k] == "cut")
                    audit, cost = audit + edits[k][0], cost + {"D": 2, "K": 0}.get(edits[k], 1)
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                best = min(best, (cost, audit, out)) if best else (cost, audit, out)
    return best


def test_edits_are_the_cheapest(spark):
    rng, convs = random.Random(5), []
    roles, texts = ["user", "assistant", "system", "tool"], ["a.", "b", "c!", "", "d"]
    for c in range(60):
        convs.append((c, [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(1, 3) if c % 4 else 2)]))
    df = spark.createDataFrame([(c, k, r, t) for c, turns in convs for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in cr.digests(df).collect()}
    lines = {}
    for r in sorted(cr.repaired(df).collect(), key=lambda r: (r.conv_id, r.place)):
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    for c, turns in convs:
        cost, audit, out = brute_repair(turns)
        assert (got[c].cost, got[c].audit) == (cost, audit), turns
        assert got[c].repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        assert lines.get(c, []) == out


def test_spilled_edits_are_the_same(spark):
    """A conversation of 30,000 turns, its edit bytes in files of 1,000, over several Arrow batches."""
    rng = random.Random(1)
    rows = [(7, k, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"t {k}."])) for k in range(30_000)] + [(8, 1, "user", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    few, all_ = cr.digests(df, spill=1000).orderBy("conv_id").collect(), cr.digests(df).orderBy("conv_id").collect()
    assert few == all_ and len(few[0].audit) >= 30_000 and few[1].audit == "D"


def test_conversations_without_rows(spark):
    ids = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((tuple(r) for r in cr.digests(none, ids=ids).collect()), key=str) == [(1, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)]
    assert cr.digests(none).count() == cr.repaired(none).count() == 0
    assert cr.damage(none).count() == 0 and pt.rebuilt_trie(none).count() == 0


@pytest.mark.parametrize("shard_rows", [1, 40, 10_000])
def test_trie_in_many_shards(spark, shard_rows, monkeypatch):
    """Small shards and heavy nodes joined by a shuffle give the same trie."""
    monkeypatch.setattr(pt, "BROADCAST_NODES", 10 if shard_rows == 40 else 100_000)
    monkeypatch.setattr(pt, "LEAST_BOUND", 1)
    rows = odd_rows(seed=9) + [(9000, k, "user", f"long {k}") for k in range(300)] + [(9001, k, "user", f"long {k}") for k in range(280)]
    columns, want = in_duck(OP13_SQL, rows)
    assert in_spark(pt.rebuilt_trie(make(spark, rows), shard_rows=shard_rows), columns) == want


def test_spilling_queue(tmp_path):
    rng = random.Random(2)
    keys = [(rng.randrange(50), bytes([rng.randrange(20)])) for _ in range(5000)]
    queue, want = SpillQueue(str(tmp_path), limit=100, batch=16, max_runs=3), {}
    for at, key in enumerate(keys):
        queue.push(key, 1, at, 2)
        a, b, c = want.get(key, (0, 0, 0))
        want[key] = (a + 1, b + at, c + 2)
    assert queue.spilled > 10 and len(list(tmp_path.iterdir())) <= 4
    for key in sorted({*want, (0, b""), (60, b"z")}):
        assert queue.take(key) == want.get(key, (0, 0, 0))
    assert not list(tmp_path.iterdir())
