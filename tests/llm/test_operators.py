"""Each text operator against brute force, on the smallest tables and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tradewind.llm import (
    chaining,
    common,
    features,
    flatgraph,
    language,
    minhash,
    mixing,
    neighbours,
    packing,
    quality,
    suffixes,
    toxicity,
)
from tradewind.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long, band long, component string, version int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, blanks, short, long, equal and nearly equal texts, and columns with names used inside."""
    base = " ".join(f"w{i % 97}x{i * i % 89}" for i in range(300))
    near = base.replace("w5x25", "other", 1)
    rows = [
        (1, base, "en", "a"), (2, base, None, None), (3, near, "en", "a"), (4, "", "en", "b"), (5, None, "en", "b"),
        (6, "One  two\tthree", "en", "b"), (7, "one two three", "en", None), (8, " \n\t ", None, "c"),
        (None, base, "en", "a"), (9, "!!! ... 123", "xx", "c"), (10, base * 20, "en", "a"),
        (11, "é" * 500, "fr", "c"), (12, "É ñ \U0001f600 <|endoftext|> a  b", "fr", "c"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), 7, "x", 1) for r in rows], ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="session")
def docs(spark):
    return common.table(spark, SF, "documents")


@pytest.fixture(scope="session")
def labels(spark):
    return common.table(spark, SF, "labels")


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect() if r.doc_id is not None}


def by_id(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_paths_stars_and_pairs(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (900, 800)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {i for pair in links for i in pair}
    assert {i: got.get(i, i) for i in ids} == roots(ids, links)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_minhash_equals_brute_force(request, which):
    frame = request.getfixturevalue(which)
    sets = {i: shingles(t) for i, t in texts(frame).items()}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    want = roots(ids, links)
    rows = minhash.near_duplicates(frame).collect()
    assert len(rows) == frame.count()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in ids
    }
    for r in rows:
        assert r.doc_id is not None or (r.component_id is None and r.kept)


def test_minhash_of_an_empty_table(empty):
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.drop_near_duplicates(empty).columns == empty.columns


def test_estimate_follows_similarity(spark):
    text = [" ".join(f"a{i}" for i in range(s, s + 400)) for s in (0, 40, 400)]
    frame = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    sig = minhash.signatures(frame)
    a = sig.select("bits", "doc_id").toDF("x", "i")
    b = sig.select("bits", "doc_id").toDF("y", "j")
    got = {(r.i, r.j): r.e for r in a.join(b).withColumn("e", minhash.estimate(a["x"], b["y"])).collect()}
    assert got[0, 0] == 1.0 and abs(got[0, 1] - 356 / 436) < 0.15 and abs(got[0, 2]) < 0.1


def _removed(frame, length):
    raw = {i: (t or "").encode() for i, t in texts(frame).items()}
    seen = Counter(b[i : i + length] for b in raw.values() for i in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("which, length, hot", [("docs", 400, 4096), ("odd", 400, 4096), ("docs", 60, 2), ("odd", 60, 1)])
def test_suffixes_equal_brute_force(request, monkeypatch, which, length, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 1 << 16)
    frame = request.getfixturevalue(which)
    rows = suffixes.repeat_digest(frame, length).collect()
    assert len(rows) == frame.count()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows if r.doc_id is not None}
    assert got == _removed(frame, length)
    assert all(r.n_removed == 0 for r in rows if r.doc_id is None)


def test_suffixes_with_every_gram_salted(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 1)
    monkeypatch.setattr(suffixes, "SALTED", 10**9)
    rows = suffixes.repeat_digest(docs.repartition(7), 60).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == _removed(docs, 60)


@pytest.mark.parametrize("rows_each", [1, 2, 5])
def test_hot_windows_are_found_however_the_slices_fall(rows_each):
    shared = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(300))
    texts = [f"{i:03d}" * (i + 1) + shared[i % 3 * 20 :] + f"tail {i}" for i in range(5)] + ["only here " * 9]
    length = 100
    grams = []
    for text in texts:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        grams.append(suffixes._anchors(data, np.array([0, len(data)]), length)[0].view(np.int64).tolist())
    whole = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(6)), "version": [7] * 6, "text": texts, "grams": pa.array(grams, pa.list_(pa.int64()))}
    )
    slices = [whole.slice(i, rows_each) for i in range(0, 6, rows_each)]
    rows = [r for one in slices for b in suffixes._hot_windows(length)(iter([one])) for r in b.to_pylist()]
    held = Counter(r["window"] for r in rows if r["window"] is not None)
    removed = {i: set() for i in range(6)}
    for r in rows:
        if r["doc_id"] is not None and (r["window"] is None or held[r["window"]] > 1):
            removed[r["doc_id"]] |= set(range(r["start"], r["end"]))
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    for i, t in enumerate(texts):
        twice = [p for p in range(len(t) - length + 1) if seen[t[p : p + length]] > 1]
        assert removed[i] == {x for p in twice for x in range(p, p + length)}


def test_suffix_cut_keeps_rows_and_columns(odd, empty):
    cut = suffixes.without_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert by_id(cut)[2].text == "" and by_id(cut)[2].n_chars == 0 and by_id(cut)[6].text == "One  two\tthree"
    assert suffixes.without_repeats(empty).count() == 0 and suffixes.repeat_digest(empty).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(1)
    keys = [bytes(rng.integers(97, 99, rng.integers(1, 12)).astype(np.uint8)) for _ in range(200)]
    runs = []
    for part in (keys[:90], keys[90:91], keys[91:]):
        part, prior, row = sorted(part), b"", {k: [] for k in ("shared", "rest", "before", "doc_id", "version", "anchor")}
        for key in part:
            n = suffixes._common(prior, key, 0)
            for name, value in (("shared", n), ("rest", key[n:]), ("before", b""), ("doc_id", 0), ("version", 0), ("anchor", 0)):
                row[name].append(value)
            prior = key
        runs.append(suffixes.Run(row))
    got = list(suffixes.merged(runs))
    assert [item[0] for _, item in got] == sorted(keys)
    ordered = sorted(keys)
    assert [n for n, _ in got[1:]] == [suffixes._common(a, b, 0) for a, b in zip(ordered, ordered[1:])]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_round_trip(request, which):
    from tokenizers import Tokenizer

    frame = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.packed(frame, capacity=256).toPandas()
    want = Counter()
    for r in frame.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        lo, hi, k = 0, len(ids) % 256 or 256, 0
        while lo < len(ids):
            crc = zlib.crc32(np.array(ids[lo:hi], dtype="<u4").tobytes())
            want[(-1 if r.doc_id is None else r.doc_id, k, lo, hi - lo, crc)] += 1
            lo, hi, k = hi, hi + 256, k + 1
    got["doc_id"] = got.doc_id.fillna(-1).astype(int)
    assert Counter(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    got = got.sort_values(["sequence_id", "offset"])
    ahead = got.groupby("sequence_id").length.cumsum() - got.length
    assert (ahead == got.offset).all() and got.groupby("sequence_id").length.sum().max() <= 256


def test_packing_plan_is_sound_and_near_the_bound():
    rng = np.random.default_rng(2)
    for _ in range(30):
        counts = Counter(rng.integers(1, 101, 300).tolist())
        plan = packing.reduce_and_fit(dict(counts), 100)
        used = Counter()
        for lengths, n in plan:
            assert sum(lengths) <= 100
            for w in lengths:
                used[w] += n
        assert used == counts
        total = sum(w * n for w, n in counts.items())
        assert sum(n for _, n in plan) <= -(-total // 100) + 12
    # Pairs that fill a sequence are fixed first.
    assert sorted(packing.reduce_and_fit({60: 2, 40: 2}, 100)) == [((60, 40), 2)]
    # The long piece is not decided, and still counts when the short ones are looked at.
    assert packing.reduce_and_fit({6: 1, 2: 2}, 10) == [((6, 2, 2), 1)]
    # Three pieces together beat the longest that fits.
    assert sum(n for _, n in packing.reduce_and_fit({100: 1, 80: 1, 30: 3, 120: 1}, 200)) == 2


def _fewest(items, capacity):
    """Fewest sequences by trying every place for every piece."""
    items, best, rooms = sorted(items, reverse=True), [len(items)], []

    def place(i):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= items[i] and room not in rooms[:j]:
                rooms[j] -= items[i]
                place(i + 1)
                rooms[j] += items[i]
        rooms.append(capacity - items[i])
        place(i + 1)
        rooms.pop()

    place(0)
    return best[0]


def test_fixed_sets_lose_nothing(monkeypatch):
    fit, rest = packing._best_fit, []
    monkeypatch.setattr(packing, "_best_fit", lambda items, capacity: rest.append(items) or [])
    for seed in range(600):
        rng = np.random.default_rng(seed)
        capacity = int(rng.choice([10, 20, 100]))
        pieces = rng.integers(max(1, capacity // 8), capacity + 1, rng.integers(1, 10)).tolist()
        fixed = sum(n for _, n in packing.reduce_and_fit(dict(Counter(pieces)), capacity))
        left = [w for w, n in rest.pop() for _ in range(n)]
        assert fixed + _fewest(left, capacity) == _fewest(pieces, capacity)
    for seed in range(1000):
        rng = np.random.default_rng(seed)
        capacity = int(rng.choice([10, 30, 100, 2048]))
        top = int(rng.choice([capacity, capacity // 2, capacity * 2 // 3]))
        counts = dict(Counter(rng.integers(1, top + 1, rng.integers(1, 60)).tolist()))
        fixed = sum(n for _, n in packing.reduce_and_fit(counts, capacity))
        whole = fixed + sum(n for _, n in fit(rest.pop(), capacity))
        assert whole <= sum(n for _, n in fit(list(counts.items()), capacity))


def test_packing_empty_table(empty):
    assert packing.packed(empty).count() == 0


def test_mixing_stays_within_one_block(docs, odd, empty, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 2048)
    for frame, weights in ((docs, None), (docs, {"src0": 5.0, "src1": 1.0, "src2": 0.5}), (odd, None)):
        plan = mixing.schedule(frame, weights).toPandas()
        assert set(plan.doc_id.dropna()) == set(texts(frame))
        assert len(plan[plan.epoch == 0]) == frame.select("doc_id", "source", "text").distinct().count()
        cycle = int(plan.cycle.iloc[0])
        per = plan.fillna({"source": "-"}).groupby("source").share.first()
        assert per.sum() == cycle
        # One source's blocks never share a slot with another's.
        assert plan.fillna({"source": "-"}).groupby("slot").source.nunique().max() == 1
        for source, rows in plan.fillna({"source": "-"}).groupby("source"):
            n_blocks = int(np.ceil((frame.where(mixing.F.coalesce("source", mixing.F.lit("-")) == source).selectExpr(
                "sum(octet_length(coalesce(text, '')) + 1)").first()[0]) / 2048))
            k = rows.block + rows.epoch * n_blocks
            share = per[source]
            assert (rows.slot >= np.floor(k * cycle / share)).all()
            assert (rows.slot < np.ceil((k + 1) * cycle / share)).all()
    assert mixing.schedule(empty).count() == 0 and mixing.mixed(empty).columns == empty.columns
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns and set(texts(mixed)) == set(texts(odd))


def test_classifiers_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    frame, marks = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    truth = by_id(marks)
    scored = [r for r in quality.quality_scores(frame, marks).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id].quality for r in scored]) > 0.9
    rows = toxicity.toxicity_scores(frame, marks).collect()
    seen = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id].toxic for r in seen]) > 0.8
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_toxic_sentence_is_located(spark):
    text = "Calm words here now. You are such a vile one! More calm words here."
    rows = [(i, text if i % 3 == 0 else "Calm words here now. More calm words here.") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = by_id(toxicity.toxicity_scores(frame, marks))
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(300))
    assert [text[s.start : s.end] for s in got[0].offending] == ["You are such a vile one!"[:-1]] or [
        text[s.start : s.end] for s in got[0].offending
    ] == ["You are such a vile one!"]


def test_classifiers_on_odd_rows(spark, odd, empty):
    marks = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    none = marks.where("false")
    for frame, with_labels in ((odd, marks), (odd, none), (empty, marks)):
        for rows in (
            quality.quality_scores(frame, with_labels).collect(),
            toxicity.toxicity_scores(frame, with_labels).collect(),
        ):
            assert len(rows) == frame.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
        assert quality.accepted(frame, with_labels).columns == frame.columns


def test_labels_and_other_columns_do_not_sway_scores(docs, labels):
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'s' AS source")
    flipped = labels.selectExpr(
        "doc_id",
        "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - quality, quality) AS quality",
        "toxic",
    )
    a, b = by_id(quality.quality_scores(docs, labels)), by_id(quality.quality_scores(other, flipped))
    assert {i: r.score for i, r in a.items()} == {i: r.score for i, r in b.items()}


def test_language(spark, docs, odd, empty):
    got = language.predicted_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in got if r.held_out]) > 0.95
    rows = by_id(language.predicted_languages(odd))
    assert [rows[i].lang_pred for i in (4, 5, 8, 9)] == ["und"] * 4 and rows[4].score == 0
    assert language.predicted_languages(empty).count() == 0
    two = spark.createDataFrame(
        [(i, "abc abd acb bca " * 30, "x") for i in range(20)] + [(i, "uvw vuw wvu uwv " * 30, "y") for i in range(20, 40)]
        + [(1000 + i, "abc abd acb bca " * 20 + "uvw vuw wvu uwv " * 10, None) for i in range(3)],
        "doc_id long, text string, lang string",
    )
    for r in language.predicted_languages(two).where("doc_id >= 1000").collect():
        assert r.lang_pred == "x" and {p.lang for p in r.languages} == {"x", "y"} and abs(r.score - 2 / 3) < 0.05


EMB = "vec_id long, embedding array<float>, label int, unit string, n int"


@pytest.fixture(scope="session")
def vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 16))
    x[100:160] = x[7] + rng.standard_normal((60, 16)) * 0.25
    x[200:230] = x[8]
    rows = [(i, [float(v) for v in r], i % 2, "u", 1) for i, r in enumerate(x)]
    rows += [(500, None, 1, "", 0), (501, [0.0] * 16, 1, "", 0), (502, [None] * 16, 1, "", 0),
             (503, [float("nan")] * 16, 0, "", 0), (504, [1.0] * 16, None, "", 0), (None, [1.0] * 16, 1, "", 0)]
    return spark.createDataFrame(rows, EMB)


@pytest.mark.parametrize("shard", [2048, 40])
def test_flat_graph_equals_brute_force(vectors, monkeypatch, shard):
    monkeypatch.setattr(flatgraph, "SHARD", shard)
    monkeypatch.setattr(flatgraph, "BLOCK", 4096 if shard > 100 else 60)
    rows = vectors.collect()
    good = [r for r in rows if r.vec_id is not None and r.vec_id < 500]
    x = np.array([r.embedding for r in good], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in good])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    want = roots(range(400), [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a > b])
    out = flatgraph.near_vectors(vectors).collect()
    assert len(out) == len(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out if r.vec_id is not None}
    assert {i: got[i] for i in range(400)} == {i: (int(near[i].sum()) - 1, want[i], want[i] == i) for i in range(400)}
    assert all(got[i] == (0, i, True) for i in range(500, 505))


def test_neighbours_recall_and_exact_scores(vectors):
    rows = [r for r in vectors.collect() if r.vec_id is not None and (r.vec_id < 500 or r.vec_id == 504)]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = neighbours.nearest(vectors).toPandas()
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        some = ids != q
        best = ids[some][np.lexsort((ids[some], -score[some]))[:20]]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21))
        assert np.allclose(mine.score, [score[ids == v][0] for v in mine.vec_id], rtol=0, atol=1e-12)
        hits, total = hits + len(set(best) & set(mine.vec_id)), total + 20
    assert hits / total >= 0.9


def test_vector_operators_on_an_empty_table(spark):
    empty = spark.createDataFrame([], EMB)
    assert neighbours.nearest(empty).count() == 0 and flatgraph.near_vectors(empty).count() == 0


def test_chaining_finds_every_exact_passage(docs, odd, empty):
    raw = texts(docs)
    seen = {}
    for i, t in raw.items():
        w = words(t)
        for k in range(len(w) - 50):
            seen.setdefault(tuple(w[k : k + 51]), set()).add(i)
    true = set().union(*[s for s in seen.values() if len(s) > 1])
    rows = chaining.shared_passages(docs).collect()
    assert true <= {r.doc_id for r in rows} | {r.other_id for r in rows}
    for r in rows:
        assert r.identity >= 0.75 and r.n_words >= 50 and r.other_id < r.doc_id
        assert len(words(raw[r.doc_id].encode()[r.start : r.end].decode())) == r.n_words
    got = {(r.doc_id, r.other_id) for r in chaining.shared_passages(odd).collect()}
    assert {(2, 1), (3, 1)} <= got and not {i for pair in got for i in pair} & {4, 5, 6, 7, 8, 9, 11, 12}
    assert chaining.shared_passages(empty).count() == 0


def test_chaining_links_documents_whose_seeds_come_first_elsewhere(spark):
    """The halves of the passage of 3 and 4 are older than both, each in a document of its own."""
    passage, rest = [f"p{i}" for i in range(60)], [f"r{i}" for i in range(160)]
    parts = [passage[:30], passage[30:], passage, passage]
    rows = [(i + 1, " ".join(rest[40 * i : 40 * i + 20] + p + rest[40 * i + 20 : 40 * i + 40])) for i, p in enumerate(parts)]
    found = chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.other_id, r.n_words, r.identity) for r in found] == [(4, 3, 60, 1.0)]


def test_chaining_finds_changed_passages(spark):
    """Between the changed words 13 stay, of which one seed at least is sure."""
    rows = []
    for k in range(60):
        passage = [f"p{k}x{i}" for i in range(55)]
        other = [f"q{k}x{i}" if i % 14 == 13 else w for i, w in enumerate(passage)]
        for i, words in enumerate((passage, other)):
            before, after = ([f"{side}{k}x{i}x{j}" for j in range(40)] for side in "ba")
            rows.append((2 * k + i, " ".join(before + words + after)))
    found = chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.other_id) for r in found) == [(2 * k + 1, 2 * k) for k in range(60)]


def test_two_passages_beside_a_gap_are_found_apart():
    """As one they agree in 120 of 175 words only."""
    x = np.arange(175, dtype=np.uint64)
    y = x.copy()
    y[60:115] += np.uint64(1000)
    places = np.concatenate([np.arange(0, 55, 5), np.arange(115, 170, 5)])
    assert chaining.align(x, y, places, places)[4] == 120
    assert chaining.passages(x, y, places, places) == {(0, 60, 0, 60, 60), (115, 175, 115, 175, 60)}


def test_seeds_of_many_holders_meet_the_first_one(spark, monkeypatch):
    monkeypatch.setattr(chaining, "FEW", 3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} c{i} {passage} d{i} e{i}") for i in range(6)]
    found = chaining.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.other_id) for r in found) == [(i, 0) for i in range(1, 6)]


def _pair_of_texts(rng):
    """Word hashes of two texts that share passages, some changed and shifted, and chains in their matches."""
    x = rng.integers(0, 50, rng.integers(20, 900)).astype(np.uint64)
    x = np.where(rng.random(len(x)) < 0.5, x, rng.integers(0, 1 << 40, len(x)).astype(np.uint64))
    y = np.where(rng.random(len(x)) < rng.choice([0.0, 0.05, 0.2, 0.6]), x + np.uint64(1), x)
    for _ in range(rng.integers(0, 3)):
        at = int(rng.integers(0, len(y)))
        y = np.concatenate([y[:at], rng.integers(0, 99, rng.integers(1, 40)).astype(np.uint64), y[at:]])
    runs = {}
    for j in range(len(y) - chaining.KMER + 1):
        runs.setdefault(y[j : j + chaining.KMER].tobytes(), []).append(j)
    found = [(i, j) for i in range(0, len(x) - chaining.KMER + 1, 3) for j in runs.get(x[i : i + chaining.KMER].tobytes(), [])]
    a, b = np.array(found or [(0, 0)]).T
    return x, y, [(a[c], b[c]) for c in chaining.chains(a, b)]


def test_chains_drawn_out_together_give_the_passages_of_each():
    rng = np.random.default_rng(11)
    pairs = [_pair_of_texts(rng) for _ in range(150)]
    x, y = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    x_at, y_at = (np.concatenate([[0], np.cumsum([len(p[side]) for p in pairs])]) for side in (0, 1))
    lists = [
        pa.array([[len(a) for a, _ in p[2]] for p in pairs], pa.list_(pa.int32())),
        *(pa.array([[int(v) for c in p[2] for v in c[side]] for p in pairs], pa.list_(pa.int32())) for side in (0, 1)),
    ]
    kept = lambda p, q, r, s, same: min(q - p, s - r) >= chaining.LEAST and same >= chaining.SAME * max(q - p, s - r)
    wanted = sorted({(k, *f) for k, p in enumerate(pairs) for c in p[2] for f in chaining.passages(p[0], p[1], *c) if kept(*f)})
    got = [tuple(f) for f in chaining._found(x, x_at, y, y_at, lists).T.tolist() if kept(*f[1:])]
    assert got == wanted and len(got) > 100
    assert any(q - p != s - r for _, p, q, r, s, _ in got) and any(q - p > chaining.STRETCH for _, p, q, *_ in got)


def test_drawn_goes_on_as_word_by_word():
    rng = np.random.default_rng(12)
    for k in range(60):
        n = int(rng.integers(1, 1500))
        x = rng.integers(0, 1 << 40, n).astype(np.uint64)
        y = np.where(rng.random(n) < rng.choice([0.0, 0.02, 0.3, 0.5, 0.9]), x + np.uint64(1), x)
        at = int(rng.integers(0, n))
        for step, words in ((1, x[at:] == y[at:]), (-1, (x[: at + 1] == y[: at + 1])[::-1])):
            best, reach, score = 0.0, 0, 0.0
            for s in range(0, len(words), chaining.STRETCH):
                for i, agrees in enumerate(words[s : s + chaining.STRETCH].tolist(), s + 1):
                    score += 1.0 if agrees else -chaining.MISMATCH
                    if score > best:
                        best, reach = score, i
                if reach < s + chaining.STRETCH:
                    break
            here = np.array([at])
            assert chaining.drawn(x, y, here, here, np.array([len(words)]), step).tolist() == [reach]


def test_straight_chains_are_not_aligned_one_by_one(monkeypatch):
    """Three hundred lone seeds of two texts, most of them chance, cost no call each."""
    calls, align = [], chaining.align
    monkeypatch.setattr(chaining, "align", lambda *a: calls.append(1) or align(*a))
    words = [f"w{i}" for i in range(6060)]
    other = [w if i >= 6000 or i < 5900 and i % 20 < 6 else f"x{i}" for i, w in enumerate(words)]
    places = [*range(0, 5900, 20), *range(6000, 6054, 6)]
    batch = pa.RecordBatch.from_pylist(
        [{"doc_id": 2, "other_id": 1, "sizes": [1] * len(places), "a": places, "b": places, "text": " ".join(words), "other_text": " ".join(other)}],
        pa.schema([
            ("doc_id", pa.int64()), ("other_id", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("sizes", "a", "b")),
            ("text", pa.string()), ("other_text", pa.string()),
        ]),
    )
    rows = [r for out in chaining._align(iter([batch])) for r in out.to_pylist()]
    assert [(r["n_words"], r["identity"], r["end"] == len(" ".join(words))) for r in rows] == [(60, 1.0, True)]
    assert not calls


def test_matches_on_one_diagonal_are_linked_as_by_the_tree():
    rng = np.random.default_rng(13)
    for _ in range(200):
        a = np.cumsum(rng.integers(1, rng.choice([3, 9, 60]), rng.integers(1, 60)))
        b = a + int(rng.integers(0, 90))
        assert chaining._linked_on_one_diagonal(a.tolist(), b.tolist()) == chaining._linked(a, b)


def test_packing_encodes_a_chunk_once_in_all_tasks_of_a_worker(monkeypatch):
    """Three tasks one after another; the later ones bring old chunks and new ones."""
    sent, encode = [], packing.Encoder._encode
    monkeypatch.setattr(packing.Encoder, "_encode", lambda self, raw: sent.extend(raw) or encode(self, raw))
    monkeypatch.setattr(packing, "_encoders", {}, raising=False)
    path = packing.tokenizer_path()
    tasks = [["Zebra ananas kumquat, quince zebra"], ["Aardvark ananas quince zoo kumquat, apple"], ["Zebra zoo", "apple apple quince"]]
    for k, rows in enumerate(tasks):
        batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in enumerate(rows)])
        sent.clear()
        found = [r for b in packing._pieces(path, 2048)(iter([batch])) for r in b.to_pylist()]
        ids = [packing.encoder_of(path).tokenizer.encode(t, add_special_tokens=False).ids for t in rows]
        assert [r["ids_crc32"] for r in found] == [zlib.crc32(np.array([*i, 0], "<u4").tobytes()) for i in ids]
        assert sorted(sent) == [
            sorted([b"Zebra", b" ananas", b" kumquat,", b" quince", b" zebra"]),
            sorted([b"Aardvark", b" zoo", b" apple"]),
            [b"apple"],
        ][k]


def test_reach_is_never_less_than_what_is_drawn_out():
    rng = np.random.default_rng(8)
    for k in range(300):
        x = rng.integers(0, 1 << 40, rng.integers(60, 500)).astype(np.uint64)
        y = np.where(rng.random(len(x)) < rng.choice([0.1, 0.3, 0.9, 1.0]), x + np.uint64(1), x)
        if k % 3 == 0:
            y[: len(y) // 2] = x[: len(x) // 2] + np.uint64(1)
        at = int(rng.integers(0, len(x) - chaining.KMER))
        y[at : at + chaining.KMER] = x[at : at + chaining.KMER]
        start, end, *_ = chaining.align(x, y, np.array([at]), np.array([at]))
        zeros = np.zeros(chaining.AROUND, np.uint8)
        cx, cy = (np.concatenate([zeros, w % np.uint64(255) + np.uint64(1), zeros]).astype(np.uint8) for w in (x, y))
        mid, after = at + chaining.AROUND, at + chaining.AROUND + chaining.KMER
        room = len(x) - at - chaining.KMER
        left = chaining.reach(*(c[None, mid - chaining.AROUND : mid][:, ::-1] for c in (cx, cy)), np.array([at]))
        right = chaining.reach(*(c[None, after : after + chaining.AROUND] for c in (cx, cy)), np.array([room]))
        assert left[0] >= min(at - start, chaining.STRETCH)
        assert right[0] >= min(end - at - chaining.KMER, chaining.STRETCH)


def test_texts_are_not_sent_for_seeds_shared_by_chance(spark):
    """Ten documents share six words with the first one, the last one a passage with each ninth word changed."""
    words = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(words))]
    rows += [(k, " ".join([*(f"a{k}x{i}" for i in range(90)), *words[20 * k : 20 * k + 6], *(f"b{k}x{i}" for i in range(90))])) for k in range(1, 11)]
    rows += [(11, " ".join(f"c{i}" if i % 9 == 4 else w for i, w in enumerate(words[230:290])))]
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    lone = [(k, 0, [1], [90], [20 * k]) for k in range(1, 11)] + [(11, 0, [1], [14], [244])]
    found = spark.createDataFrame([*lone, (12, 0, [2], [0, 9], [0, 9])], chaining._CHAIN)
    assert sorted((r.doc_id, r.other_id, r.a) for r in chaining._likely(found, whole).collect()) == [(11, 0, [14]), (12, 0, [0, 9])]


def test_chain_is_the_best_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.integers(0, 80, 14), rng.integers(0, 80, 14)
        best = next(chaining.chains(a, b))
        assert (np.diff(a[best]) > 0).all() and (np.diff(b[best]) > 0).all()


def test_a_second_passage_far_on_is_one_chain():
    a = np.concatenate([np.arange(0, 200, 8), np.arange(400, 460, 8)])
    b = np.concatenate([np.arange(0, 200, 8), np.arange(500, 560, 8)])
    found = sorted((int(a[c[0]]), int(a[c[-1]]), len(c)) for c in chaining.chains(a, b))
    assert found == [(0, 192, 25), (400, 456, 8)]


def test_alignment_counts_across_an_insertion():
    x = np.arange(100, dtype=np.uint64)
    y = np.concatenate([x[:50], [900, 901, 902], x[50:]]).astype(np.uint64)
    assert chaining.align(x, y, np.array([10, 70]), np.array([10, 73])) == (0, 100, 0, 103, 100)


def test_grams_are_counted_within_their_text():
    rows = pa.RecordBatch.from_pylist([{"doc_id": i, "version": 0, "text": t} for i, t in enumerate(["ab " * 2000, "ab " * 500])])
    found = [r for b in suffixes._keys(60)(iter([rows])) for r in b.to_pylist()]
    data, at = common.text_bytes(rows.column("text"))
    hashes, text, *_ = suffixes._anchors(data, at, 60)
    want = Counter(zip(text.tolist(), hashes.view(np.int64).tolist()))
    assert len(found) == len(want) < len(hashes) / 100
    assert {(r["doc_id"], r["gram"]): r["times"] for r in found} == want


def test_pipeline_takes_out_passages_of_fifty_words(spark):
    """Three hundred bytes that two documents share."""
    passage = " ".join(f"p{i:04}" for i in range(51))
    rows = [(i, " ".join(f"{j:05}{c}" for j in range(80)) + f" {passage} {c}end") for i, c in enumerate("ab")]
    cut = dict(corpus_pipeline.STAGES)["suffix_array_dedup"](spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert len(passage) < 400 and texts(cut) == {i: t.replace(f" {passage} ", "") for i, t in rows}


def test_pipeline_stages_keep_their_contract(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "suffix_array_dedup", "mixing_to_weights", "best_fit_packing",
    ]
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    scored = {r.doc_id for r in quality.quality_scores(docs, common.table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert ids <= scored
    near = by_id(minhash.near_duplicates(docs.where(docs.doc_id.isin(sorted(scored)))))
    assert ids == {i for i, r in near.items() if r.kept}


def test_words_equal_the_plain_expression():
    some = ["", "a", " a  b\tc ", "É x\x0bY", "x" * 10, "\n"]
    data, at = common.text_bytes(pa.array(some))
    found = common.Words(data, at)
    got = [[bytes(data[s:e]) for s, e in zip(found.starts[a:b], found.ends[a:b])] for a, b in zip(found.at, found.at[1:])]
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", t.encode()) for t in some]
    tokens = features.Tokens(*common.text_bytes(pa.array(["ab,,c  d"])))
    assert len(tokens.starts) == 4
