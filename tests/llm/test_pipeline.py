"""The pipeline, stage by stage, against plain versions on small tables."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as pipeline
from shoptrail.llm import secrets
from shoptrail.llm.queries import documents
from shoptrail.llm.packing import choose_lengths
from shoptrail.llm.tables import stage
from tests.conftest import SMALL


def ws(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The small documents and, made of halves of two of them, texts with
    secrets: four owners share one value, two values have one owner each."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs = documents(spark, SMALL)
    prose = sorted(r["doc_id"] for r in docs.where("lang = 'en'").collect() if 100 < len(ws(r["text"])) < 600)
    text = {r["doc_id"]: r["text"].split() for r in docs.where("lang = 'en'").collect()}
    made = []
    for i, secret in enumerate(["api_key=EXAMPLE0EXAMPLE"] * 4 + ["password: Hq7TsecretQ9", "key Zx9Zx8Zx7Zx6Zx5Zx4Zx3 end"]):
        a, b = text[prose[2 * i]], text[prose[2 * i + 1]]
        made.append((900_000 + i, " ".join(a[:len(a) // 2] + [secret] + b[:len(b) // 2]), "en", f"src{i}", 0))
    both = docs.unionByName(spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long"))
    both.write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """(name, rows in, rows out) of every stage; each reads what the one
    before wrote."""
    docs, out = documents(spark, sf_dir), []
    for name, step in pipeline.STAGES:
        done = stage(step(spark, docs, sf_dir), f"test-{name}")
        if name != pipeline.STAGES[-1][0]:
            assert done.columns == docs.columns
        out.append((docs.collect(), done.collect()))
        docs = done
    return dict(zip([n for n, _ in pipeline.STAGES], out))


def test_language_stage_keeps_clean_texts(steps):
    before, after = steps["language_id"]
    rows = {r["doc_id"]: r for r in before}
    assert len(after) == len({r["doc_id"] for r in after}) and all(rows[r["doc_id"]] == r for r in after)
    kept = {r["doc_id"] for r in after}
    assert not [r for r in after if not any(c.isalpha() for c in r["text"] or "")]
    clean = [r["doc_id"] for r in before if r["lang"] is not None and sum(c.isalpha() or c == " " for c in r["text"] or "") > 0.9 * len(r["text"] or "x")]
    assert clean and len(kept.intersection(clean)) >= 0.98 * len(clean)


def test_near_duplicate_stage_by_brute_force(steps):
    before, after = steps["near_dedup"]
    sets, parent = {}, {}
    for r in before:
        w = [x.lower() for x in ws(r["text"])]
        sets[r["doc_id"]] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
        parent[r["doc_id"]] = r["doc_id"]

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    seen = defaultdict(set)
    for i in sorted(sets):
        for j, n in Counter(j for g in sets[i] for j in seen[g]).items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            seen[g].add(i)
    want = [r for r in before if find(r["doc_id"]) == r["doc_id"]]
    assert len(want) < len(before)
    assert sorted(after, key=lambda r: r["doc_id"]) == sorted(want, key=lambda r: r["doc_id"])


def test_secret_stage_by_plain_ownership(steps):
    before, after = steps["secrets"]
    assign = re.compile(secrets.ASSIGN.replace("(?i)", ""), re.I | re.A)

    def candidates(t):
        base = [(m.start(), m.end(), m[2]) for m in assign.finditer(t) if len(m[2]) >= 8]
        base += [(m.start(), m.end(), m[0]) for m in re.finditer(secrets.ACCESS, t) if len(m[0]) >= 16]
        base += [(m.start(), m.end(), m[0]) for m in re.finditer(secrets.HEX, t) if len(m[0]) >= 32]
        long = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t)
                if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
        return base + [x for x in long if not any(x[0] < e and s < x[1] for s, e, _ in base)]
    owners = defaultdict(set)
    for r in before:
        for _, _, value in candidates(r["text"] or ""):
            owners[value].add(r["source"])
    got, masked = {r["doc_id"]: r for r in after}, 0
    assert len(got) == len(after) == len(before)
    for r in before:
        spans = []
        for s, e, value in sorted(candidates(r["text"] or "")):
            if len(owners[value]) < 3:
                if spans and s < spans[-1][1]:
                    spans[-1][1] = max(e, spans[-1][1])
                else:
                    spans.append([s, e])
        text = r["text"]
        for s, e in reversed(spans):
            text = text[:s] + "[SECRET]" + text[e:]
        masked += bool(spans)
        assert got[r["doc_id"]]["text"] == text
        assert got[r["doc_id"]]["n_chars"] == (None if text is None else len(text))
    made = {i: got[i]["text"] for i in got if i >= 900_000}
    assert masked >= 2 and sum("EXAMPLE0EXAMPLE" in t for t in made.values()) == 4
    assert not [t for t in made.values() if "Hq7T" in t or "Zx9Zx8" in t]


def test_mixing_stage_takes_prefixes_to_the_budget(steps):
    before, after = steps["mixing"]
    words, cut = {r["doc_id"]: ws(r["text"]) for r in before}, Counter()
    for r in after:
        w = ws(r["text"])
        assert w and w == words[r["doc_id"]][:len(w)]
        cut[r["source"], r["lang"]] += len(w) < len(words[r["doc_id"]])
    assert sum(len(ws(r["text"])) for r in after) == sum(map(len, words.values())) * 80 // 100
    assert max(cut.values()) <= 1 and max(Counter(r["doc_id"] for r in after).values()) <= 2


def test_packing_stage_by_plain_pieces(steps):
    before, after = steps["packing"]
    pieces = Counter((r["doc_id"], p, min(2048, n - 2048 * p)) for r in before for n in [len(ws(r["text"]))] for p in range(max(1, -(-n // 2048))))
    assert Counter((r["doc_id"], r["piece"], r["n_tokens"]) for r in after) == pieces
    lengths = choose_lengths(Counter(n for _, _, n in pieces.elements() if n), 16)
    load = Counter()
    for r in after:
        if r["n_tokens"]:
            assert r["bucket_len"] == next(x for x in lengths if x >= r["n_tokens"])
            load[r["bucket"], r["batch"]] += r["bucket_len"]
    assert max(load.values()) <= 65_536


def test_run_gives_the_last_stage(spark, steps, sf_dir):
    want = steps["packing"][1]
    got = pipeline.run(spark, sf_dir).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want)) and got[0].__fields__ == want[0].__fields__
