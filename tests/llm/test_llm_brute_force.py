"""The registered queries against plain computations, round trips and held-out labels."""

import hashlib
import html
import os
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from widerow.llm import secrets, tokens, toxicity  # noqa: E402
from widerow.llm import shard as shards  # noqa: E402
from widerow.llm.common import isotonic, table  # noqa: E402
from widerow.llm.components import components  # noqa: E402
from widerow.llm.oracles import oracle_sql  # noqa: E402
from widerow.llm.pack import CAPACITIES, plan, token_cost  # noqa: E402
from widerow.llm.queries import VOCABULARY, queries  # noqa: E402
from widerow.llm.shard import interleave, write_shards  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents benchmark labels pages embeddings conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def texts(duck):
    return duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def rows_of(spark, name, sf_dir=SF_DIR):
    return queries()[name](spark, sf_dir).collect()


def test_registered():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(oracle_sql()[name])
    at = [d[0] for d in result.description]
    assert sorted(at) == columns
    expected = sorted(tuple(r[at.index(c)] for c in columns) for r in result.fetchall())
    assert sorted(tuple(r) for r in df.select(columns).collect()) == expected


@pytest.mark.parametrize(
    "name,label,least,recall",
    [("op1_toxicity", "toxic", 0.5, 0.6), ("op3_quality_classifier", "quality", 0.7, 0.95)],
)
def test_held_out_labels(spark, name, label, least, recall):
    known = {r["doc_id"]: r[label] for r in table(spark, LARGER, "labels").collect()}
    got = rows_of(spark, name, LARGER)
    parts = (5, 0) if label == "toxic" else (4, 2)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts[0] == parts[1])
        assert r["predicted"] == int(r["score"] >= least)
    held = [(known[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in known]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert np.mean([b for a, b in held if a == 1]) >= recall


def test_index_is_exact():
    rng = random.Random(1)

    def vector():
        raw = {rng.randrange(30): rng.random() for _ in range(rng.randrange(1, 6))}
        size = sum(x * x for x in raw.values()) ** 0.5
        return {t: x / size for t, x in raw.items()}

    vectors = [vector() for _ in range(500)]
    vectors += vectors[:100]
    index = toxicity.Index(vectors, block=8)
    for k in range(100):
        query = vector()
        scores = [
            round(sum(w * v.get(t, 0.0) for t, w in query.items()), 9)
            for i, v in enumerate(vectors) if i != k
        ]
        best = sorted((s for s in scores if s > 0), reverse=True)[:10]
        assert [s for s, _ in index.nearest(query, 10, without=k)] == pytest.approx(best, abs=1e-8)


def test_toxicity_matches_scoring_all_examples(spark, duck):
    """Scores and evidence of the query, with plain vectors and every cosine."""
    import regex

    docs = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    labels = duck.sql("SELECT doc_id, toxic FROM labels WHERE toxic IN (0, 1) ORDER BY 1").fetchall()
    words = {d: regex.findall(r"[\p{L}\p{M}\p{N}]+", (t or "").lower()) for d, t in docs.items()}
    examples = {}
    for d, toxic in labels:
        if d in docs and zlib.crc32(str(d).encode()) % 5:
            examples.setdefault((tuple(words[d]), toxic), d)
    ids = sorted((d, toxic) for (_, toxic), d in examples.items())
    n, positive = len(ids), sum(toxic for _, toxic in ids)
    held, hits = Counter(), Counter()
    for d, toxic in ids:
        held.update(set(words[d]))
        hits.update(set(words[d]) if toxic else ())
    weight = {}
    for w, k in held.items():
        g = 0.0
        for seen, share in ((hits[w], positive / n), (k - hits[w], 1 - positive / n)):
            g += 2 * seen * np.log(max(seen, 1) / (k * share))
        g = max(0.0, g)
        least = toxicity.LEAST_WEIGHT
        weight[w] = (np.log((1 + n) / (1 + k)) + 1) * ((g / (g + toxicity.DOUBT)) ** 2 + least)
    unknown = (np.log(1 + n) + 1) * toxicity.LEAST_WEIGHT

    def vector(d):
        v = {w: (1 + np.log(c)) * weight.get(w, unknown) for w, c in Counter(words[d]).items()}
        size = sum(x * x for x in v.values()) ** 0.5
        return {w: x / size for w, x in v.items()}

    vectors = {d: vector(d) for d, _ in ids}
    average = positive / n

    def near(d, own):
        v = vector(d)
        found = [
            (round(sum(x * u.get(w, 0.0) for w, x in v.items()), 9), e, toxic)
            for e, toxic in ids if not (own and e == d) for u in [vectors[e]]
        ]
        return sorted((f for f in found if f[0] > 0), key=lambda f: -f[0])[: toxicity.NEIGHBOURS]

    def vote(found):
        by = [(1 / max(0.05, 1 - c), toxic) for c, _, toxic in found]
        return (sum(w * t for w, t in by) + average) / (sum(w for w, _ in by) + 1)

    votes = [(round(vote(near(d, True)), 3), toxic) for d, toxic in ids]
    points = Counter(v for v, _ in votes)
    at, to = isotonic([(v, k, sum(t for w, t in votes if w == v)) for v, k in points.items()])
    for r in rows_of(spark, "op1_toxicity"):
        found = near(r["doc_id"], False)
        cosines = [c for c, _, _ in found]
        got = [(e["cosine"], e["id"], e["label"]) for e in r["evidence"]]
        assert [c for c, _, _ in got] == pytest.approx(cosines[: len(got)], abs=3e-9)
        for c, e, toxic in got:
            assert dict(ids)[e] == toxic
        assert r["score"] == pytest.approx(np.interp(vote(found), at, to), abs=0.02), r["doc_id"]


def test_rare_words_count_and_every_text_has_neighbours(spark):
    rng = random.Random(3)
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = []
    for i in range(120):
        words = rng.sample(plain, 40)
        if i < 20:  # five marks, each in four toxic examples
            words.insert(20, "mark" + "abcde"[i % 5])
        rows.append((i, " ".join(words), int(i < 20)))
    rows += [(200 + i, " ".join([*rng.sample(plain, 30), "mark" + "abcde"[i]]), None) for i in range(5)]
    rows += [(300 + i, " ".join(rng.sample(plain, 30)), None) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"), "toxic", df["doc_id"] < 200)
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    for i in range(5):
        assert got[200 + i]["score"] >= 0.5
        assert {e["id"] % 5 for e in got[200 + i]["evidence"]} == {i}
    assert all(got[300 + i]["score"] < 0.5 for i in range(20))
    assert all(len(r["evidence"]) == toxicity.EVIDENCE for r in got.values())


def test_isotonic():
    at, to = isotonic([(0.0, 2, 1), (1.0, 2, 0), (2.0, 1, 1), (3.0, 4, 4)])
    assert list(to) == [0.25, 1.0] and list(at) == [0.5, 2.8]


def test_extraction(spark, duck):
    got = {r["page_id"]: r for r in rows_of(spark, "op2_html_extraction")}
    pages = duck.sql("SELECT page_id, html FROM pages").fetchall()
    assert len(got) == len(pages)
    for page, source in pages:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", source or "", re.S)
        body = re.sub(r"<br>", " ", article[1] if article else "")
        body = re.sub(r"</?b>", "", re.sub(r"<[^>]*\Z", "", body))
        lines = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", body))
        expected = "\n".join(x for x in lines if x)
        assert got[page]["text"] == expected
        assert got[page]["n_chars"] == len(expected)


def test_style_tree_removes_repeated_branches(spark):
    from widerow.llm.extract import extract

    rows = [
        (i, f"http://h{i % 2}/p{i}", f"<div class=x{i}><div class=promoted>Buy it now</div>"
         f"<div class=body><p>Text {i} of its own</p></div></div>")
        for i in range(40)
    ]
    rows += [(99, "http://other/", "<div class=a><div class=promoted>Buy it now</div><p>x</p></div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert all(got[i] == f"Text {i} of its own" for i in range(40))


def plain_secrets(text):
    """All parts of a text, and those of them that are reported, pair by pair."""
    parts = sorted(
        (m.start(), kind, m.end())
        for p, kind, _ in secrets._PARTS
        for m in re.finditer(p, text or "", re.A)
        if kind or len(m[2]) >= 6
    )

    def gap(p, q):  # the code points between them, below 0 if they overlap
        return max(p[0], q[0]) - min(p[2], q[2])

    parts = [p for p in parts if p[1] != 5 or all(q[1] == 5 or gap(p, q) >= 0 for q in parts)]
    complement = {3: (0, 2, 5), 4: (0, 2, 5), 5: (1, 3, 4)}
    return parts, [
        p for p in parts
        if p[1] <= 2
        or any(q[1] in complement[p[1]] and gap(p, q) <= secrets.SCOPE for q in parts)
    ]


def test_secret_spans(spark, texts):
    got = {r["doc_id"]: r for r in rows_of(spark, "op5_secret_scan")}
    for doc, text in texts:
        parts, kept = plain_secrets(text)
        strong = [p for p in parts if p[1] <= 2]
        assert got[doc]["spans"] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in kept)
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in strong)
        assert got[doc]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        counts = Counter(k for _, k, _ in strong)
        assert [got[doc][f"n_{k}"] for k in secrets.KINDS[:3]] == [counts[k] for k in range(3)]


def test_secret_parts_of_random_texts(spark):
    """Parts of all kinds and lengths, apart by gaps on both sides of the scope."""
    rng = random.Random(8)
    bits = [
        lambda: "secret=" + "x" * rng.randrange(4, 400), lambda: "user=bob",
        lambda: "AKIA" + "A1" * 8, lambda: "0a" * 12, lambda: "https://h.example.org/a1" + "s" * rng.randrange(300),
        lambda: "ann@example.com", lambda: "10.0.0.1:22", lambda: "a" * 70 + "1234567890",
        lambda: "1" * 80 + "abc", lambda: "eyJhbGciOi1.eyJzdWIiOi2.sflKxwRJSM3", lambda: "plain words.",
        lambda: "a-long-run-of-letters-only", lambda: "..ab12ab12ab12ab12ab12..", lambda: "\U0001f600",
    ]
    texts = []
    for _ in range(300):
        text = ""
        for _ in range(rng.randrange(1, 5)):
            text += rng.choice(bits)() + " " + "-" * rng.choice([0, 0, 100, 253, 254, 255, 256]) + " "
        texts.append(text)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = secrets.find_secrets(df).collect()
    reported = Counter()
    for r in found:
        expected = plain_secrets(texts[r["i"]])[1]
        assert [(s["start"], s["kind"], s["end"]) for s in r["secrets"]] == expected
        reported.update(k for _, k, _ in expected)
    assert all(reported[k] for k in range(6))


def test_whole_runs_are_candidates(spark):
    long, reverse = "a" * 70 + "1234567890", "1234567890" * 8 + "abc"
    token = "eyJhbGciOi1.eyJzdWIiOi2.sflKxwRJSM3"
    texts = [f"user=bob {x}." for x in (long, reverse, token)]
    texts += ["see https://www.example.org/page1 now", "user=bob only-letters-in-a-long.run 12345678901234567890"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = secrets.find_secrets(df)
    cut = found.select("i", secrets.redacted(found["text"], found["secrets"]).alias("t"))
    assert [r["t"] for r in cut.orderBy("i").collect()] == ["[REDACTED] [REDACTED]."] * 3 + texts[3:]


def test_weak_parts_need_each_other(spark):
    texts = [
        "mail ann@example.com and key Zx81kdkQwe93LmnopQ2 here",
        "mail ann@example.com alone", "key Zx81kdkQwe93LmnopQ2 alone",
        "mail ann@example.com " + "-" * 300 + " key Zx81kdkQwe93LmnopQ2",
        "host 10.0.0.1:22 password=hunter22",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = secrets.find_secrets(df)
    got = {r["i"]: [s["kind"] for s in r["secrets"]] for r in found.collect()}
    assert got == {0: [3, 5], 1: [], 2: [], 3: [], 4: [4, 0]}
    cut = found.select("i", secrets.redacted(found["text"], found["secrets"]).alias("t")).collect()
    by = {r["i"]: r["t"] for r in cut}
    assert by[0] == "mail [REDACTED] and key [REDACTED] here" and by[1] == texts[1]
    assert by[4] == "host [REDACTED] [REDACTED]"


def test_long_parts_reach_their_neighbours(spark):
    texts = [
        "secret=" + "x" * 300 + " user=bob",
        "https://h/" + "s" * 300 + " key Zx81kdkQwe93LmnopQ2",
        "secret=" + "x" * 300 + " " + "-" * 300 + " user=bob",
        "user=bob " + "-" * 240 + " secret=" + "x" * 300,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: [s["kind"] for s in r["secrets"]] for r in secrets.find_secrets(df).collect()}
    assert got == {0: [0, 3], 1: [4, 5], 2: [0], 3: [3, 0]}


def best_fit(lengths):
    """Item by item: (capacity at last, contents) of each bin."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[0] - b[1] >= n]
        if fitting:
            min(fitting, key=lambda b: b[0] - b[1])[1] += n
        else:
            sizes = [c for c in CAPACITIES if c >= n]
            bins.append([min(sizes, key=lambda c: (token_cost(c) / (c // n), c)), n])
    return sorted((min(c for c in CAPACITIES if c >= used), used) for _, used in bins)


def test_packing(spark, texts):
    got = rows_of(spark, "op6_best_fit_packing")
    pieces, lengths = {}, []
    for doc, text in texts:
        n = len((text or "").encode()) + 1
        lengths += [CAPACITIES[-1]] * (n // CAPACITIES[-1]) + [n % CAPACITIES[-1]] * (n % CAPACITIES[-1] > 0)
        pieces[doc] = n
    total = Counter()
    bins = {}
    for r in got:
        total[r["doc_id"]] += r["piece_length"]
        bins.setdefault(r["bin_id"], []).append(r)
    assert total == pieces
    for held in bins.values():
        held.sort(key=lambda r: r["bin_offset"])
        ends = np.cumsum([0, *(r["piece_length"] for r in held)])
        assert [r["bin_offset"] for r in held] == list(ends[:-1])
        assert len({r["bin_capacity"] for r in held}) == 1
    packed = sorted((b[0]["bin_capacity"], sum(r["piece_length"] for r in b)) for b in bins.values())
    assert packed == best_fit(lengths)


def test_plan_of_many_items():
    made = plan([(1, 10**9), (700, 10**9), (16384, 5)])
    assert len(made.runs) < 20 and made.n_bins > 10**7


def test_fingerprints(spark, texts):
    got = {r["doc_id"]: r for r in rows_of(spark, "op7_document_fingerprints")}

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    errors = []
    for k, (doc, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        row = got[doc]
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["n_chars"] == len(text)
        a, b = shingles(text), shingles(changed)
        if min(len(a), len(b)) >= 100:
            errors.append(abs(row["near_edited"] - len(a & b) / min(len(a), len(b))))
    assert np.mean(errors) < 0.05


def test_longest_match(texts):
    entries = tokens.load_vocabulary(VOCABULARY)
    known = {*entries, tokens.END}
    automaton = tokens.LongestMatch([*entries, tokens.END])
    for word in {w for _, t in texts for w in tokens.words_of(t)}:
        left, n = word.encode().decode("latin-1") + tokens.END, 0
        while left:
            size = next(k for k in range(len(left), 0, -1) if left[:k] in known)
            n += left[:size] != tokens.END
            left = left[size:]
        assert automaton.count(word.encode().decode("latin-1") + tokens.END) == n


def test_longest_match_first_and_later():
    automaton = tokens.LongestMatch(["a", "ab", "abcd"], ["c", "cx", "b"])
    assert [automaton.count(w) for w in ["a", "ab", "abc", "abcd", "abcx", "abb", "ca", "abcc", "abca", ""]] == [
        1, 1, 2, 1, 2, 2, None, 3, None, 0,
    ]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]
    least = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in got} == {n: least[n] for n in linked}
    assert len(got) == len(linked)


def test_a_large_group_of_near_copies(spark):
    """Chains, stars and blocks: every link found, none added."""
    from widerow.llm import neardup

    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    docs = [(0, " ".join(base))]
    for i in range(1, 300):
        words = list(rng.choice(docs)[1].split() if i % 3 else base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    sets = [set(neardup.shingles(t.encode()).tolist()) for _, t in docs]
    least = list(range(300))
    pairs = [
        (i, j) for i in range(300) for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    for _ in range(50):
        for i, j in pairs:
            least[i] = least[j] = min(least[i], least[j])
    block, neardup.BLOCK = neardup.BLOCK, 16
    try:
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = neardup.near_duplicates(df).collect()
    finally:
        neardup.BLOCK = block
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(least))


def test_shards(spark, duck, tmp_path):
    got = rows_of(spark, "op10_sharding")
    documents = duck.sql("SELECT doc_id, source, text FROM documents").fetchall()
    source = {d: s for d, s, _ in documents}
    facts = {(d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, _, t in documents}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == facts
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    sizes = Counter(source.values())
    inside = Counter((r["shard"], source[r["doc_id"]]) for r in got)
    for shard in counts:
        for name, n in sizes.items():
            assert abs(inside[shard, name] - n / 16) <= 2
    whole = interleave(table(spark, SF_DIR, "documents"), ["doc_id"], shards=4)
    write_shards(whole, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(documents)


def test_pipeline(spark, duck):
    """Each stage against plain rules on the stage's own input."""
    docs = table(spark, SF_DIR, "documents")
    held, inputs = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        inputs[name] = held
        held = stage(spark, held, SF_DIR).cache()
    rows = {name: {r["doc_id"]: r["text"] for r in df.collect()} for name, df in inputs.items()}
    last = {r["doc_id"]: r["text"] for r in held.collect()}
    steps = [*rows.values(), last]
    assert all(set(b) <= set(a) for a, b in zip(steps, steps[1:]))
    quality = {r[0]: r[1] for r in duck.sql("SELECT doc_id, quality FROM labels").fetchall()}
    kept = rows["MinHash near-dedup"]
    assert np.mean([d in kept for d, q in quality.items() if q]) > 0.9
    assert len({t for t in rows["benchmark decontamination"].values()}) == len(
        rows["benchmark decontamination"]
    )
    for text in last.values():
        assert not re.search(secrets.ACCESS, text)
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    total = Counter()
    for r in packed:
        total[r["doc_id"]] += r["piece_length"]
    assert total == {d: len((t or "").encode()) + 1 for d, t in last.items()}


def test_small_sources_fill_all_shards(spark):
    """Half of the rows in one source, the rest in sources of one row or three."""
    rows = [(i, "big") for i in range(800)] + [(1000 + i, f"one{i}") for i in range(800)]
    rows += [(3000 + i, f"three{i // 3}") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = interleave(df, ["doc_id"]).collect()
    count = Counter((r["shard"], r["source"][:3]) for r in got)
    for shard in range(16):
        assert abs(count[shard, "big"] - 50) <= 3
        assert abs(count[shard, "one"] - 50) <= 3
        assert abs(count[shard, "thr"] - 15) <= 3
    again = interleave(df.repartition(5), ["doc_id"]).collect()
    assert sorted(got) == sorted(again)


def test_repeated_rows_spread(spark, monkeypatch):
    monkeypatch.setattr(shards, "PER_BUCKET", 50)
    rows = [(1, "a")] * 600 + [(i, "a") for i in range(2, 202)] + [(None, None)] * 200
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = [tuple(r) for r in interleave(df, ["doc_id"], shards=4).collect()]
    count = Counter((r[2], r[0] == 1) for r in got)
    for k in range(4):
        assert abs(count[k, True] - 150) <= 30
        assert sorted(r[3] for r in got if r[2] == k) == list(range(250))
    again = [tuple(r) for r in interleave(df.repartition(7), ["doc_id"], shards=4).collect()]
    assert sorted(got, key=str) == sorted(again, key=str)


def test_bitmaps_never_exclude_a_link():
    from widerow.llm import neardup

    rng = np.random.default_rng(2)
    sets, pairs = [], []
    for _ in range(400):
        n = int(rng.integers(1, 600))
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        keep = rng.random(n) < rng.uniform(0.5, 1)
        more = rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)
        pairs.append((len(sets), len(sets) + 1))
        sets += [np.unique(base), np.unique(np.concatenate([base[keep], more]))]
    maps = [neardup.bitmap(x) if len(x) else b"\0" * 8 for x in sets]
    sizes = np.array([len(x) for x in sets])
    able = [(i, j) for i, j in pairs if 75 * max(sizes[i], sizes[j]) <= 100 * min(sizes[i], sizes[j])]
    i, j = np.array(able).T
    got = neardup._able(maps, sizes, i, j)
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in able])
    linked = 100 * both >= 75 * (sizes[i] + sizes[j] - both)
    far = 100 * both < 65 * (sizes[i] + sizes[j] - both)
    assert linked.sum() > 50 and far.sum() > 20
    assert got[linked].all() and not got[far & (sizes[i] > 50)].any()


def test_an_id_with_several_texts_links_by_each(spark):
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, "other words of no one else")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from widerow.llm.neardup import near_duplicates

    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_recall_of_barely_linked_pairs(spark):
    """Of pairs with a similarity of 0.75 to 0.8 all are found."""
    from widerow.llm.neardup import near_duplicates, shingles

    rng = random.Random(11)
    rows, pairs = [], []
    for i in range(0, 3000, 2):
        words = [f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(60, 200))]
        other = words[: -round(len(words) * rng.uniform(0.18, 0.26))]
        if rng.random() < 0.5:
            at = rng.randrange(len(words))
            other = [*words[:at], f"x{rng.randrange(10**9)}", *words[at:]]
            other = other[: round(len(other) * rng.uniform(0.82, 0.9))]
        rows += [(i, " ".join(words)), (i + 1, " ".join(other))]
        x, y = (set(shingles(t.encode()).tolist()) for _, t in rows[-2:])
        if 75 * len(x | y) <= 100 * len(x & y) <= 80 * len(x | y):
            pairs.append((i, i + 1))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    component = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    found = sum(component[a] == component[b] for a, b in pairs)
    print(f"recall at 0.75 to 0.8: {found} of {len(pairs)}")
    assert len(pairs) > 300 and found == len(pairs)


def test_near_dedup_stage_keeps_one_row_of_a_group(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(5, text), (5, text), (None, text), (None, text), (3, text + " x"), (None, "b c"),
            (None, "b c"), (7, None), (7, None), (8, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'s' AS source", "1L AS n_chars", "'clash' AS _row"
    )
    got = corpus_pipeline.near_dedup(spark, df, SF_DIR).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(3, text + " x"), (None, "b c"), (7, None), (7, None), (8, ""), (None, None)], key=str
    )


def plain_sketch(text):
    """The sorted kept hashes of a text's runs of five words, as signed numbers."""
    import xxhash

    words = re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ").lower().split(" ")
    words = [] if words == [""] else words
    hashes = set()
    for i in range(max(1, len(words) - 4) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        hashes.add(h)
    kept = {h for h in hashes if h >> 1 < int(0.25 * (1 << 63))}
    signed = [h - (1 << 64) if h >> 63 else h for h in hashes]
    if not kept:
        return [min(signed)] if signed else []
    return sorted(h - (1 << 64) if h >> 63 else h for h in kept)


def test_fingerprints_match_plain_ones(spark, texts):
    """All columns of the query, from the texts alone."""
    got = {r["doc_id"]: r for r in rows_of(spark, "op7_document_fingerprints")}
    docs = [(d, t or "") for d, t in texts]
    assert len(got) == len(docs)

    def named(sketch):
        return ",".join(f"{h & (1 << 64) - 1:x}" for h in sketch)

    def contained(a, b):
        if not a or not b:
            return float(not a and not b)
        return len(set(a) & set(b)) / min(len(a), len(b))

    for i, (d, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        own, other, after = map(plain_sketch, (text, changed, following))
        r = got[d]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"].lower() == named(own)
        assert r["edited_fingerprint"].lower() == named(other)
        assert r["near_edited"] == pytest.approx(contained(own, other))
        assert r["near_next"] == pytest.approx(contained(own, after))


def test_token_counts_match_greedy_cutting(spark, texts):
    """The query's three numbers, piece by piece."""
    known = {*tokens.load_vocabulary(VOCABULARY), tokens.END}
    longest = max(map(len, known))
    sizes = {}

    def pieces(word):
        left, n = word.encode().decode("latin-1") + tokens.END, 0
        while left and left != tokens.END:
            size = next((k for k in range(min(longest, len(left)), 0, -1) if left[:k] in known), 0)
            if not size:
                return None
            left, n = left[size:], n + 1
        return n

    got = {r["doc_id"]: r for r in rows_of(spark, "op8_token_counts")}
    for d, text in texts:
        words = tokens.words_of(text or "")
        for w in words:
            if w not in sizes:
                sizes[w] = pieces(w)
        cut = [sizes[w] for w in words]
        unknown = sum(n is None for n in cut)
        assert got[d]["n_words"] == len(words) and got[d]["n_unknown"] == unknown
        assert got[d]["n_tokens"] == sum(n or 0 for n in cut) + unknown


def test_pipeline_stages_match_plain_rules(spark, duck):
    """From the second stage on, what each keeps or changes of its own input."""
    items = duck.sql("SELECT text FROM benchmark").fetchall()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def words(text):
        return word.findall((text or "").translate(lower))

    windows = set()
    for (text,) in items:
        w = words(text)
        windows.update(tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9) if w else 0))
    sizes = {len(w) for w in windows}
    held = table(spark, SF_DIR, "documents").select(corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in held.collect()}
        held = stage(spark, held, SF_DIR).cache()
        after = {r["doc_id"]: r["text"] for r in held.collect()}
        if name == "MinHash near-dedup":
            sets = {}
            for d, t in before.items():
                w = (t or "").translate(lower).split()
                sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4) if w else 0)}
            least = {d: d for d in before}
            by_run = {}
            for d, s in sets.items():
                for run in s:
                    by_run.setdefault(run, []).append(d)
            pairs = {(a, b) for ids in by_run.values() for a in ids for b in ids if a < b}
            linked = [
                (a, b) for a, b in pairs
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
            ]
            for _ in range(len(linked)):
                changed = False
                for a, b in linked:
                    low = min(least[a], least[b])
                    changed |= least[a] != low or least[b] != low
                    least[a] = least[b] = low
                if not changed:
                    break
            assert after == {d: t for d, t in before.items() if least[d] == d}
        if name == "benchmark decontamination":
            clean = {
                d: t for d, t in before.items()
                if not any(
                    tuple(w[i : i + n]) in windows
                    for w in [words(t)] for n in sizes for i in range(len(w) - n + 1)
                )
            }
            assert after == clean
        if name == "secret scan":
            for d, t in before.items():
                kept, at = "", 0
                for start, _, end in plain_secrets(t)[1]:
                    if start >= at:
                        kept += t[at:start] + "[REDACTED]"
                    at = max(at, end)
                assert after[d] == (t if t is None else kept + t[at:])


@pytest.mark.parametrize("window", [1, 2, 3, 9, 10])
def test_scanner_finds_every_window(window):
    """Texts made of cut and joined items, against all windows at all places."""
    from widerow.llm.decontaminate import Scanner, words_of

    rng = random.Random(window)
    items = [
        (rng.choice([str(k), str(k), None]), " ".join(rng.choice("abcde") + rng.choice("xyz")
         for _ in range(rng.randrange(0, 40))))
        for k in range(60)
    ]
    items += items[:5]
    scanner = Scanner(items, window)
    windows = {}
    for item, text in items:
        w = text.split()
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).update([item] if item else [])
    some = 0
    for _ in range(150):
        text = []
        for _ in range(rng.randrange(1, 5)):
            w = rng.choice(items)[1].split()
            a = rng.randrange(len(w) + 1)
            text += w[a : a + rng.randrange(1, 25)] + rng.choice([[], ["other"], ["ax"]])
        hit, names = set(), set()
        for key, own in windows.items():
            for i in range(len(text) - len(key) + 1):
                if tuple(text[i : i + len(key)]) == key:
                    hit.update(range(i, i + len(key)))
                    names |= own
        ranges, found = scanner.scan(words_of(" ".join(text).encode()))
        assert {i for a, b in ranges for i in range(a, b + 1)} == hit and found == names
        some += bool(hit)
    assert some > 20


def test_many_items_are_one_scan(spark, monkeypatch):
    from widerow.llm import decontaminate as d

    def refuse(df):
        raise AssertionError("documents are stored between scans")

    monkeypatch.setattr(d, "stored", refuse)
    items = spark.range(60_000).selectExpr(
        "id AS item_id",
        "array_join(transform(sequence(0, 19), i -> concat('w', pmod(hash(id, i), 100000))), ' ') AS text",
    )
    total = items.selectExpr("sum(length(text)) AS n").first()["n"]
    assert total > 7 << 20
    docs = items.filter("item_id % 6000 = 7").selectExpr(
        "item_id AS doc_id", "concat('before ', substring_index(text, ' ', 12), ' after') AS text"
    )
    found = d.decontaminate(docs, items)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = found.select("doc_id", "n_hit", "items").collect()
    assert len(got) == 10
    assert all(r["n_hit"] == 12 and r["items"] == [str(r["doc_id"])] for r in got)


def test_index_leaves_light_words_to_bounds_and_is_exact():
    rng = random.Random(2)

    def vector():
        raw = {10 + min(389, int(rng.expovariate(0.02))): 1.0 for _ in range(20)}
        raw |= {rng.randrange(10): rng.random() for _ in range(4)}
        raw |= {400 + rng.randrange(300): 0.02 for _ in range(30)}  # long lists, light
        size = sum(x * x for x in raw.values()) ** 0.5
        return {t: x / size for t, x in raw.items()}

    vectors = [vector() for _ in range(3000)]
    index = toxicity.Index(vectors)
    assert (index.kind[400:] < -1).sum() > 100 and (index.kind[:10] >= 0).all()
    read = sum(np.diff(index.lists))
    assert read < 0.6 * sum(map(len, vectors))  # before, all but the common words had lists
    queries = [vector() for _ in range(40)] + [{450: 1.0}, {10: 0.6, 405: 0.8}, {}]
    as_arrays = [(np.array([*q], int), np.array([*q.values()], float)) for q in queries]
    for query, got in zip(queries, index.search(as_arrays, 15)):
        scores = (round(sum(w * v.get(t, 0.0) for t, w in query.items()), 9) for v in vectors)
        best = sorted((s for s in scores if s > 0), reverse=True)[:15]
        assert [s for s, _ in got] == pytest.approx(best, abs=1e-8)


def test_words_are_those_of_the_pattern():
    rng = random.Random(3)
    odd = "aZ09 \t\n\x1c\x00._-'éÉßİ́²½Ⅷ漢字かе  \ud800😀‍٣"
    texts = ["".join(rng.choices(odd, k=rng.randrange(30))) for _ in range(3000)] + ["", "a.b c"]
    for text in texts:
        assert toxicity.words_of(text) == toxicity._WORD.findall(text.lower())
