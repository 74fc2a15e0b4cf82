"""Operators 11 to 13 against brute force: conversation repair by plain
string minimisation, lexical search and the Jaccard join by full comparison."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptrail.llm import conversation_repair, jaccard_join, lexical_search, near_dedup
from shoptrail.llm.queries import documents
from tests.conftest import SMALL

CONV = "conv_id long, turn long, role string, text string, conv string, kind string, faults string, letters string"
ODD = "doc_id long, text string, doc string, key string, hot string, n string, th string, rank string, no_id string"


# ---- 11 ----

def damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


STEPS = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """Faults, cost, audit and repaired rows by comparing whole strings."""
    seen, faults = set(), []
    for _, _, r, x in rows:
        held = re.findall(r"[^\x20\x09-\x0D]", x)
        faults.append(1 if not held else 2 if (r, x) in seen else 3 if held[-1] not in ".!?" else 0)
        seen.add((r, x))
    n = len(rows)

    @lru_cache(None)
    def rest(i, state, inserts):
        ways = [(0, "", ())] if i == n and state in "0a" else []
        for role in ("user", "assistant"):
            after = STEPS.get((state, role[0]))
            if after and inserts < 2 and rest(i, after, inserts + 1):
                cost, audit, kept = rest(i, after, inserts + 1)
                ways.append((cost + 5, "I" + audit, (role + ":",) + kept))
        if i < n:
            role, text = rows[i][2:]
            late = 5 if faults[i] == 3 else 0
            edits = [("D", 2, state, None)]
            if faults[i] not in (1, 2):
                edits += [("K", late, STEPS.get((state, role[:1])), role)]
                edits += [("R", late + 1, STEPS.get((state, r[0])), r) for r in ("user", "assistant")]
            for letter, price, after, name in edits:
                if after and rest(i + 1, after, 0):
                    cost, audit, kept = rest(i + 1, after, 0)
                    ways.append((cost + price, letter + audit, ((f"{name}:{text}",) if name is not None else ()) + kept))
        return min(ways) if ways else None
    for i in range(n, -1, -1):
        for state in "0sua":
            for inserts in (2, 1, 0):
                rest(i, state, inserts)
    cost, audit, kept = rest(0, "0", 0)
    turns = [t for _, t, _, _ in rows if t is not None]
    first = [r[:1] for _, _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in (1, 2, 3)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest())


def expected_repairs(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]]
    for r in damaged(rows):
        by[r[0]].append(r)

    def place(r):
        return r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()
    nothing = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    return {c: cheapest(sorted(v, key=place)) if v else nothing for c, v in by.items()}


def repairs(table, **more):
    return {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair_damaged(table, **more).collect()}


def test_repair_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert repairs(table) == expected_repairs([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_repair_planted(spark):
    """Every fault, ties, nulls, other roles, a conversation over many blocks."""
    rng = random.Random(1)
    texts = ["Hi.", "no end", "", None, " ", "Really?", "x!", "dup.", "\xa0"] + [f"t{i}." for i in range(20)]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "umbrella"]
    rows = [(c, rng.choice([t, t, t, None, 3 * t]), rng.choice(roles), rng.choice(texts))
            for c in [*range(200), None, 2**62 + 1] for t in range(rng.randint(1, 14))]
    rows += [(999, t, rng.choice(roles[:6]), rng.choice([*texts, *[f"u{t}."] * 9])) for t in range(700)]
    rows += [(1000, None, None, None)] * 3 + [(1001, 5, "user", "same.")] * 40
    table = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], CONV)
    want = expected_repairs(rows)
    assert repairs(table) == want
    assert repairs(table, block=7) == want
    edits = conversation_repair.repair(table.where("conv_id = 999"), block=7).where("role is not null").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in edits))
    assert repairs(table.where("false")) == {}


# ---- 12 ----

def words_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def expected_ranks(docs, items, top=50):
    held = [(i, Counter(words_of(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for i, text in items:
        wanted[i].update(words_of(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for (doc, c), n in zip(held, sizes):
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // n_terms)))
                        for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


DOCS = [(1, "Alpha beta, gamma-delta ALPHA"), (2, "alpha"), (2, "alpha"), (None, "alpha"), (3, None), (4, ""), (5, " .,;"), (6, "É é beta2 beta"),
        (7, "alphabet alpha_beta x" * 50), (2**62 + 1, "delta gamma"), (8, "beta " * 3000), (9, "\x00alpha\x7fbeta\xa0")]
ITEMS = [(1, "alpha BETA beta"), (1, "gamma"), (None, "É delta"), (2, None), (3, "..."), (4, "absent words"), (5, "beta\xa0 x alphabet")]


@pytest.mark.parametrize("shard", [20_000, 2])
def test_lexical_search(spark, shard):
    docs = spark.createDataFrame([(*r, *["x"] * 7) for r in DOCS], ODD)
    items = spark.createDataFrame([(*r, "x", "x") for r in ITEMS], "item_id long, text string, item string, term string")
    for top in (50, 2):
        got = [tuple(r) for r in lexical_search.search(docs, items, top=top, shard_terms=shard).select("item_id", "rank", "doc_id", "score").collect()]
        assert sorted(got, key=str) == expected_ranks(DOCS, ITEMS, top)
    assert lexical_search.search(docs.where("false"), items).count() == 0
    assert lexical_search.search(docs, items.where("false")).count() == 0


# ---- 13 ----

def expected_links(rows, percent=80):
    """(n_shingles, component) of every doc_id, by counting shared shingles."""
    sets, inverted, parent = {}, defaultdict(set), {}
    for doc, text in rows:
        w = [x.lower() for x in (text or "").encode().split()]
        sets[doc] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in sorted(sets):
        for j, n in Counter(j for g in sets[i] for j in inverted[g]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            inverted[g].add(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def chains():
    """Copies with edits around one passage, at many lengths: hot segments
    that lie in many groups."""
    rng = np.random.default_rng(5)
    core = [f"c{i}" for i in range(60)]
    out = [(100_000 + i, " ".join(core + [f"o{i}_{j}" for j in range(int(rng.integers(1, 40)))])) for i in range(120)]
    for i in range(300):
        w = list(core)
        for j in rng.integers(0, 60, int(rng.integers(0, 4))):
            w[j] = f"x{rng.integers(0, 30)}"
        out.append((200_000 + i, " ".join(w[:int(rng.integers(5, 60))])))
    return out


@pytest.mark.parametrize("hot", [64, 2])
def test_jaccard_join_brute_force(spark, hot):
    rows = [tuple(r) for r in documents(spark, SMALL).select("doc_id", "text").collect()] + chains()
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected_links(rows)


def test_every_similar_pair_meets_in_a_segment_at_any_allocation():
    """The pigeonhole itself: sets at exactly the similarity bound differ by at
    most one shingle in a raised segment, or not at all in a plain one."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(2, 200))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        lost = int(rng.integers(0, n // 5 + 1))
        b = a[lost:] if rng.random() < 0.5 else np.r_[a[lost // 2:], rng.integers(0, 2**63, lost // 4, dtype=np.uint64)]
        if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        big, small = (a, b) if len(a) >= len(b) else (b, a)
        bands = jaccard_join._places([small], 80)[0]
        (full, dels, sizes), = jaccard_join.keys([np.unique(small)], bands, 80)
        (probe, cut, _), = jaccard_join.keys([np.unique(big)], bands, 80)
        assert jaccard_join._places([big], 80)[0][0] - bands[0] in (0, 1)
        equal = int((full == probe).sum())
        raised = len(sizes)
        one = sum(full[i] == probe[i] or full[i] in cut or probe[i] in dels for i in range(raised))
        assert equal >= 1 and one >= 1
        skipped = np.flatnonzero(full == probe)[:raised]  # skip as many equal ones as can be paid for
        rest = [i for i in range(len(full)) if i not in set(skipped)]
        paid = [i for i in rest if i < raised][:len(skipped)]
        if len(paid) == len(skipped):
            assert any(full[i] == probe[i] for i in rest) or any(full[i] in cut or probe[i] in dels for i in paid)


def test_sketches_send_only_close_pairs(spark):
    """No similar pair is lost, at any ratio of widths; far pairs that share much do not send their sets."""
    rng = np.random.default_rng(4)
    sets, pairs = [], []
    for i in range(240):
        n, lost = int(rng.choice([1, 3, 15, 16, 17, 62, 66, 130, 250, 260, 520])), [0.05, 0.2, 0.3, 0.5, 0.9][i % 5]
        a = np.unique(rng.integers(-2**63, 2**63, n, dtype=np.int64))
        b = np.unique(np.r_[a[int(n * lost / 2):], rng.integers(-2**63, 2**63, int(n * lost / 2), dtype=np.int64)])
        b = b[:max(1, n // 9)] if lost == 0.9 else b
        sets += [(2 * i, a.tolist(), jaccard_join.sketch(a.view(np.uint64)).view(np.int64).tolist()),
                 (2 * i + 1, b.tolist(), jaccard_join.sketch(b.view(np.uint64)).view(np.int64).tolist())]
        pairs.append((2 * i, 2 * i + 1, len(set(a.tolist()) ^ set(b.tolist())), len(np.intersect1d(a, b)), n))
    table = spark.createDataFrame(sets, jaccard_join.SETS)
    asked = spark.createDataFrame([p[:2] for p in pairs], "u long, v long")
    a, b = (table.select(F.col("doc_id").alias(x), F.col("sketch").alias(k)) for x, k in (("u", "ku"), ("v", "kv")))
    turned = {r["u"]: r["d"] for r in asked.join(a, "u").join(b, "v").select("u", jaccard_join._differ("ku", "kv").alias("d")).collect()}
    assert all(turned[u] <= d for u, _, d, _, _ in pairs)
    close = {r["u"] for r in jaccard_join._close(asked, table, 80).collect()}
    assert all(u in close for u, _, d, met, _ in pairs if 100 * met >= 80 * (met + d))
    far = [u for u, _, d, met, n in pairs if n > 100 and u % 10 == 6]  # 0.60, of one width or two
    assert len(far) > 8 and sum(u in close for u in far) < len(far) / 4


def test_rare_shingles_alone_become_rows(spark, monkeypatch):
    """Many sets that share three quarters: pairs of 0.80 are all found, and no set is spelled out whole."""
    rng = np.random.default_rng(5)
    core, sets = rng.integers(0, 2**62, 90, dtype=np.int64), []
    for i in range(300):
        own = rng.integers(0, 2**62, 30, dtype=np.int64)
        sets.append(np.unique(np.r_[core, own]))
        if i % 10 == 0:
            sets.append(np.unique(np.r_[core, own[:24], rng.integers(0, 2**62, 6, dtype=np.int64)]))
    frame = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sets)], "doc_id long, shingles array<long>")
    members = frame.select("doc_id", F.size("shingles").cast("long").alias("n"), F.col("doc_id").alias("group"))
    staged = {}

    def kept(df, name, real=near_dedup.stage):
        staged[name] = df, real(df, name)
        return staged[name][1]
    monkeypatch.setattr(near_dedup, "stage", kept)
    got = {(r["u"], r["v"]) for r in near_dedup._rare(members, frame, 80).collect()}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert len(want) >= 30 and want <= got
    made, rows = staged["rare"]
    assert "Generate" not in made._jdf.queryExecution().toString()
    assert 0 < rows.count() < sum(map(len, sets)) / 5


def test_jaccard_join_edges(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (5, "A b  c"), (None, "a b c"), (None, None), (7, long), (8, long), (8, long),
            (9, "a b c d e f"), (10, "one set"), (10, "another set"), (2**62 + 1, "another set")]
    table = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], ODD)
    got = sorted((tuple(r) for r in jaccard_join.jaccard_join(table).collect()), key=str)
    n = len(expected_links([(0, long)])) and expected_links([(0, long)])[0][0]
    first = [r for r in got if r[0] == 10]
    assert len(first) == 2 and {r[2] for r in first} == {10}
    assert [r for r in got if r[0] not in (10, 2**62 + 1)] == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (None, 1, None), (None, 0, None), (7, n, 7), (8, n, 7), (8, n, 7), (9, 2, 9)], key=str)
    assert jaccard_join.jaccard_join(table.where("false")).count() == 0
    assert jaccard_join.jaccard_join(table.select("doc_id", F.lit(None).cast("string").alias("text"))).where("n_shingles > 0").count() == 0
