"""Spelling forms, token files and repaired conversations against brute force."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradewind.llm import common, conversations, queries, spelling, tokenfiles

SF = "/root/testdata/sf0.001"
LONG = "variants of spelling, " * 70_000 + "x" * 3_000_000 + " end."
# Columns that share names with the operators' own.
CLASHES = "doc_id long, text string, word string, n long, part int, key long, hash long, row long, gone boolean"


@pytest.fixture(scope="module")
def odd(spark):
    texts = [
        (1, "Spelling spelling SPELLING spellin spellings speling ÉÀ÷×Ÿ"), (1, "Spelling spelling again again"),
        (1, "Spelling spelling again again"), (2, None), (3, ""), (None, "spelling spellings"), (None, None),
        (4, " \t\n"), (5, LONG), (7, "a\x1cb\x85c　d <|endoftext|>, İΣ's. x́"), (6, "éééééééé éééééééé ééééééé ééééééé"),
    ]
    return spark.createDataFrame([(*t, "w", 1, 2, 3, 4, 5, True) for t in texts], CLASHES)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASHES)


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents")


# Spelling.


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def deletions(word):
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_variants(words):
    holders = {}
    for w in words:
        for d in deletions(w):
            holders.setdefault(d, set()).add(w)
    near = {w: {o for d in deletions(w) for o in holders[d] if one_edit(w, o)} for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def variants_of(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


@pytest.mark.parametrize("which,limit", [("docs", 1024), ("docs", 3), ("odd", 1024)])
def test_spelling_equals_brute_force(request, which, limit):
    frame = request.getfixturevalue(which)
    want = brute_variants(brute_words([(r.doc_id, r.text) for r in frame.collect()]))
    got = spelling.variants(frame, limit=limit).collect()
    assert len(got) == len(want)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want


def test_forms_and_chains(spark):
    """Ties go to the smaller word, forms are followed to the end."""
    counts = {
        "abcdefg": 1000, "abcdefgh": 100, "abcdefghi": 10, "abcdefghij": 1, "xbcdefg": 9, "zzzzzzzz": 50,
        "zzzzzzz": 5, "zzzzzzzzz": 50, "qqqqqqq": 3,
    }
    rows = [(i, f"{w} ") for i, (w, n) in enumerate(counts.items()) for _ in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = variants_of(spelling.variants(frame, damaged=0))
    assert got == brute_variants({w: n for w, n in counts.items() if n > 1})
    assert got["abcdefghi"][:2] == ("abcdefgh", "abcdefg") and got["zzzzzzz"][0] == "zzzzzzzz"


def test_one_block_of_many_words_is_cut(spark):
    """A third of all words with one beginning and one end, more than a block may hold."""
    letters = "abcdefghij"
    words = {f"commonstart{a}{b}{c}commonend" for a in letters for b in letters for c in letters}
    words |= {f"{a}{b}other{b}{a}rest" for a in letters for b in letters}
    frame = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n long")
    pairs = {(r.word, r.near) for r in spelling.near_words(frame, limit=50).collect()}
    assert pairs == {(a, b) for a in words for b in words if one_edit(a, b)}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=6), max_size=25))
def test_sorted_list_scan(words):
    listed = sorted(words)
    got = list(spelling.near_pairs(listed))
    assert len(got) == len(set(got))
    assert set(got) == {(i, k) for k in range(len(listed)) for i in range(k) if one_edit(listed[i], listed[k])}


def test_long_text_is_read_in_pieces():
    text = "word " * 300_000 + "y" * 2_500_000 + ", Ünd tail"
    runs = [w for piece in spelling._runs(text) for w in piece.split()]
    assert runs == [w.encode("latin-1") for w in re.findall("[a-zÀ-ÿ]+", text)]


def test_spelling_of_nothing(empty):
    assert spelling.variants(empty).count() == 0


# Token files.


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenfiles.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return tokenfiles.WordEncoder(tokenfiles.tokenizer_path())


PARTS = [
    "a", "B", "é", "'s", "'", "Σ", "ß", "İ", " ", "  ", "\t", "\x0b", "\x0c", "\x1c", "\x85", " ", "　",
    "́", "̸", ".", ",", "!", "€", "=", "≠", "1", "٣", "\U0001f600", "<|endoftext|>", "<|startoftext|>",
    "'LL", "\x00", "ﬁ", "word", "Word.", "x, ", "-", "…", "\n",
]


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=4))
def test_words_encode_as_the_whole_text(encoder, tokenizer, texts):
    ids, sizes = encoder(pa.array(texts))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 70_000) | st.integers(0, 2**32 - 1), max_size=600), min_size=1, max_size=5),
    st.integers(0, 10**6),
)
def test_any_token_is_read_alone(tmp_path_factory, docs_ids, seed):
    ids = np.array([i for d in docs_ids for i in d], np.uint32)
    sizes = np.array([len(d) for d in docs_ids])
    path = tmp_path_factory.mktemp("shard") / "one.dac"
    path.write_bytes(tokenfiles.image([None, *range(1, len(docs_ids))], sizes, ids, 1))
    shard = tokenfiles.Shard(path.as_uri())
    assert shard.documents()[0] == [None, *range(1, len(docs_ids))]
    assert np.diff(shard.documents()[1]).tolist() == sizes.tolist()
    assert shard.tokens(0, len(ids)).tolist() == ids.tolist()
    pick = random.Random(seed)
    for _ in range(min(20, len(ids))):
        at, end = pick.randrange(len(ids)), pick.randrange(len(ids) + 1)
        assert shard.token(at) == ids[at]
        assert shard.tokens(min(at, end), max(at, end)).tolist() == ids[min(at, end) : max(at, end)].tolist()
    with pytest.raises(IndexError):
        shard.token(len(ids))
    shard.close()


def test_a_token_costs_few_bytes(tmp_path):
    """One id out of a million is read without the rest of the file."""
    ids = np.arange(1_000_000, dtype=np.uint32) % 50_000
    path = tmp_path / "many.dac"
    path.write_bytes(tokenfiles.image([1], np.array([len(ids)]), ids, 1))
    shard, read = tokenfiles.Shard(path.as_uri()), []
    inner = shard.file

    class Counting:
        def read_at(self, n, at):
            read.append(n)
            return inner.read_at(n, at)

    shard.file = Counting()
    assert shard.token(777_777) == ids[777_777]
    assert sum(read) < 300


def same_tokens(frame, got, tokenizer):
    key = {}
    for r in frame.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        key.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    rows = sorted(got, key=lambda r: r.start)
    at, seen = 0, {}
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        seen.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in key.items()}
    order = [r.doc_id for r in rows]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_files_hold_all_documents(request, which, tokenizer):
    frame = request.getfixturevalue(which)
    got = tokenfiles.token_digest(frame, tokenfiles.tokenizer_path()).collect()
    same_tokens(frame, got, tokenizer)


def test_small_files_and_ids(spark, docs, tokenizer):
    """Many files of a few thousand ids; the ids come back as they are."""
    folder = tokenfiles.new_folder(spark)
    manifest = tokenfiles.write_tokens(docs, folder, tokenfiles.tokenizer_path(), shard_ids=2000)
    files = manifest.collect()
    assert len(files) > 20 and sum(f.n_docs for f in files) == docs.count()
    got = tokenfiles.read_tokens(manifest, with_ids=True)
    same_tokens(docs, got.drop("ids").collect(), tokenizer)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got.collect():
        assert r.ids == [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]


def test_files_of_nothing(empty):
    assert tokenfiles.token_digest(empty, tokenfiles.tokenizer_path()).count() == 0


# Conversations.

AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(turns):
    """Least (cost, letters) by trying everything; turns are (initial, fault)."""

    @functools.lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(turns) and state in ("", "a"):
            ways.append((0, ""))
        if inserted < 3:
            cost, rest = best(i, AFTER[state], inserted + 1)
            ways.append((cost + 3, "I" + rest))
        if i < len(turns):
            initial, fault = turns[i]
            cost, rest = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + rest))
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                if initial == "s" and not state or initial and initial in "ua" and AFTER[state] == initial:
                    cost, rest = best(i + 1, initial, 0)
                    ways.append((cost + extra, "K" + rest))
                cost, rest = best(i + 1, AFTER[state], 0)
                ways.append((cost + 3 + extra, "R" + rest))
        return min(ways) if ways else (10**9, "")

    return best(0, "", 0)


def damage(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def brute_repairs(rows):
    held = {}
    for r in rows:
        kept = held.setdefault(r.conv_id, [])
        turn, role, text = r.turn, " " if r.role is None else r.role, " " if r.text is None else r.text
        h = damage(r.conv_id, turn)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(h, text)
        kept += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    out = {}
    for conv, kept in held.items():
        kept.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
        seen, turns, faults = set(), [], Counter()
        for _, role, text in kept:
            marks = re.findall("[^\x20\x09-\x0d]", text)
            fault = "blank" if not marks else "duplicate" if (role, text) in seen else ""
            fault = fault or ("" if marks[-1] in ".!?" else "truncated")
            seen.add((role, text))
            faults[fault] += 1
            turns.append((role[:1], fault))
        numbers = {k[0] for k in kept if k[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum((a + b) not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
        cost, audit = cheapest(tuple(turns))
        state, i, lines = "", 0, []
        for letter in audit:
            if letter != "D":
                role, text = ({"u": "user", "a": "assistant"}[AFTER[state]], "") if letter != "K" else (kept[i][1], "")
                if letter != "I":
                    text = kept[i][2]
                lines.append(f"{role}:{text}")
                state = role[0]
            i += letter != "I"
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha)
    return out


def repairs_of(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
        for r in rows
    }


@pytest.fixture(scope="module")
def odd_talks(spark):
    """Nulls, odd roles, equal rows, repeated turns, a conversation of one dropped row, a long text."""
    pick = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "Yes.", "no", "", " \t", None, "Why? ", "a\nb.", "x" * 50_000 + "."]
    rows = [
        (pick.choice([*range(12), None]), pick.choice([*range(9), None, -3]), pick.choice(roles), pick.choice(texts))
        for _ in range(150)
    ]
    # Distinct texts at one turn in one role have no stated order; one of them stays.
    rows = list({(*r[:2], None if damage(*r[:2]) == 4 else r[2]): r for r in rows}.values())
    rows += [(100, t, r, "Same words.") for t in range(6) for r in ("user", "assistant")] * 2
    dropped = next(c for c in range(1000, 2000) if damage(c, 0) == 0)
    rows += [(dropped, 0, "user", "Hello.")]
    fields = "conv_id long, turn long, role string, text string, gone int, seg int, code string, hash long"
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], fields)


@pytest.mark.parametrize("segment", [4096, 3, 1])
@pytest.mark.parametrize("which", ["given", "odd"])
def test_repairs_equal_brute_force(spark, odd_talks, which, segment):
    frame = common.table(spark, SF, "conversations") if which == "given" else odd_talks
    got = repairs_of(conversations.repair_digest(conversations.damaged(frame), segment))
    assert got == brute_repairs(frame.collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suaxuaua"), st.sampled_from([0, 0, 0, 1, 2])), max_size=14))
def test_walk_is_the_cheapest_and_least(turns):
    names = {0: "", 1: "blank", 2: "truncated"}
    codes = [conversations._code(r, f) for r, f in turns]
    audit, _, cost = conversations.walk(codes, conversations.END)
    assert (cost, audit) == cheapest(tuple((r, names[f]) for r, f in turns))


def test_checkpoints_are_few():
    step, kept = conversations.checkpoints([1, 2] * 5000, conversations.END)
    assert step == 100 and len(kept) <= 102


def test_a_conversation_of_a_third_of_all_rows(spark):
    """One conversation too long for a task, by segments and as one; its repaired turns alternate."""
    pick = random.Random(9)
    rows = [(1, t, pick.choice(["user", "assistant", "tool"]), pick.choice(["Ok.", f"Turn {t}.", "cut", ""])) for t in range(3000)]
    rows += [(2 + t // 6, t % 6, pick.choice(["user", "assistant"]), f"Say {t}.") for t in range(6000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = repairs_of(conversations.repair_digest(conversations.damaged(frame)))
    assert repairs_of(conversations.repair_digest(conversations.damaged(frame), 200)) == whole
    _, chunks = conversations.repair(frame, 200)
    turns = conversations.repaired_turns(chunks.where("conv_id = 1")).orderBy("place").collect()
    assert [t.place for t in turns] == list(range(len(turns)))
    assert re.fullmatch("s?(ua)+", "".join(t.role[0] for t in turns))


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_digest(conversations.damaged(none)).count() == 0


def test_every_query_has_sql_or_a_test_by_brute_force():
    tested = {
        "op2_mixing", "op4_quality", "op5_toxicity", "op6_suffix_array", "op7_language", "op8_chaining",
        "op9_packing", "op10_multiprobe", "op11_spelling", "op12_token_files", "op13_conversations",
    }
    assert set(queries.queries()) == set(queries.oracle_sql()) | tested
