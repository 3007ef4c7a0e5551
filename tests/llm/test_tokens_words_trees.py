"""Token counts, spelling variants and the manifest: against plain versions and the library, with odd and hot inputs."""

import random
from zlib import crc32

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import manifest, spelling, token_counts
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merger():
    return token_counts.PairMerger(PATH, token_counts.newer_characters())


def counted(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "\n", "'ll", "aaaa", "the", "é", " ", "1２³", "日本"]), max_size=20).map("".join))
def test_counts_are_those_of_the_library(library, merger, text):
    assert merger.count(text) == counted(library, text)


def test_characters_that_one_table_lacks(library, merger):
    newer = token_counts.newer_characters()
    rnd = random.Random(4)
    for _ in range(300):
        text = "".join(rnd.choice([*rnd.sample(newer, 3), "a", " ", "1", "́", "."]) for _ in range(20)) if newer else "a"
        assert merger.count(text) == counted(library, text)


def test_long_pieces(library, merger):
    for text in ("a" * 50_000, "ab" * 30_000, "-" * 40_001, " " * 20_000 + "x", "the quick " * 60_000):
        assert merger.count(text) == counted(library, text)


def test_count_tokens(spark, library, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 50)
    rows = [(1, None, 5, "k"), (2, "", 5, "k"), (3, "hello <|endoftext|> world", 5, "k"), (3, "hello <|endoftext|> world", 5, "k"), (None, "ünïcode " * 100, 5, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, N_Bytes string")
    got = token_counts.count_tokens(df, PATH)
    assert got.columns == ["doc_id", "text", "n_bytes", "n_tokens"]
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got.collect()) == sorted((len((t or "").encode()), counted(library, t or "")) for _, t, *_ in rows)
    assert token_counts.count_tokens(df.limit(0), PATH, keep=["doc_id"]).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.PairMerger(public_tokenizers.path("word_bpe_49k.json"))


def accepted(words, length, edits):
    words = sorted(words)
    found = [tuple(sorted((words[i], words[j]))) for i, j in spelling.OneEdit(words, length).pairs(edits)]
    assert len(found) == len(set(found))
    return set(found)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 6).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.text("abc", min_size=n, max_size=n) | st.text("abc", min_size=n + 1, max_size=n + 1), min_size=1, max_size=40))))
def test_composition_gives_each_pair_once(case):
    n, words = case
    want = {(a, b) for a in words for b in words if a < b and brute.one_edit(a, b) and min(len(a), len(b)) == n}
    assert accepted(words, n, n + 1) == want

    def place(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    assert accepted(words, n, n // 2) == {(a, b) for a, b in want if place(a, b) < n // 2}


def test_acceptor_is_minimal_and_numbers_its_strings():
    words = sorted({a + b + c for a in "abcdefgh" for b in ("ing", "ed", "") for c in ("s", "")})
    a = spelling.Acceptor(words)
    assert len(a.arcs) == 7  # the start, after the letter, i, in, e, before an s that may follow, and after it
    for number, word in enumerate(words):
        state, before = a.start, 0
        for c in word:
            state, skip = a.arcs[state][c]
            before += skip
        assert a.final[state] and before == number


def test_very_long_words():
    one = "xy" * 10_000
    words = [one, one[:10_000] + "z" + one[10_001:], one + "y", "x" + one, one[:5000] + "q" + one[5000:], "y" + one[1:]]
    assert accepted(words, 20_000, 20_001) == {tuple(sorted((a, b))) for a in words for b in words if len(a) == 20_000 and a != b and brute.one_edit(a, b)}


@pytest.mark.parametrize("limit", [3, 20_000])
def test_variants(spark, limit):
    rnd = random.Random(8)
    counts = {}
    for _ in range(700):
        word = "pre" + "".join(rnd.choice("aé") for _ in range(rnd.randint(0, 6))) + rnd.choice(["", "fix"])
        counts[word] = rnd.choice([3, 4, 4, 8, 16, 17, 40, 100])
    counts |= {"x": 1, "xy": 2, "ÿ": 9, "solitary": 5}
    rows = [(w, n, "c", 1) for w, n in counts.items()] + [(None, 3, "c", 1), ("", 3, "c", 1), ("nothing", None, "c", 1)]
    df = spark.createDataFrame(rows, "word string, n long, key string, best int")
    got = {r["word"]: tuple(r)[1:] for r in spelling.group_variants(df, limit).collect()}
    assert got == brute.variants(counts)
    assert spelling.group_variants(df.limit(0), limit).collect() == []


def test_chains_of_forms(spark):
    chain = [("abcdefgh" + "z" * k, 2**k) for k in range(12)]
    got = spelling.group_variants(spark.createDataFrame(chain, "word string, n long")).collect()
    assert {r["root"] for r in got} == {chain[-1][0]} and sorted(r["n_near"] for r in got) == [1, 1] + [2] * 10


def test_count_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONG_TEXT", 100)
    monkeypatch.setattr(spelling, "HELD_WORDS", 2)
    rows = [(i, " ".join(rnd_words(i)), 0) for i in range(60)] + [(1, None, 0), (None, "Zebra ZEBRA zebra's ÀZEBRA àzebra", 0), (7, "", 0), (8, "Straße×x " * 3, 0), (8, "Straße×x " * 3, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    want = {}
    for i, text, _ in rows:
        for run in brute.re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] = want.get(run, 0) + 1
    got = {r["word"]: r["n"] for r in spelling.count_words(df, min_length=4, min_count=2, slip=3).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 4 and n >= 2}
    assert spelling.count_words(df.limit(0)).collect() == []


def rnd_words(seed):
    rnd = random.Random(seed)
    return [rnd.choice(["Anchor", "river", "stone", "Bridge", "été", "Übermut", "naïve"]) for _ in range(40)]


def steps(r):
    return [(s["left"], s["right"]) for s in r["steps"]]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, monkeypatch, levels):
    """Blocks of 3, 9 and 729 nodes, so that trees take several tiers; a hot group, nulls, repeated rows and ids."""
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "RANGE_ROWS", 40)
    rows = [(i, "hot", f"t{i}") for i in range(100 if levels == 1 else 250)] + [(i, f"s{i % 7}", "x") for i in range(23)] + [(5, "é", None), (None, "s1", "n"), (9, None, "z"), (9, None, "z")]
    rows += [(3, "hot", "again"), (3, "hot", "t3"), (1, "Z", "only")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, g int")
    fields = lambda text: manifest.leaf_hash([F.col("doc_id"), F.col("source"), text])
    got = manifest.manifest(df, fields(F.col("text")), seen=F.when(F.col("doc_id") % 2 == 0, fields(F.lit("forged"))))
    got = got.withColumn("own", manifest.fold(F.col("leaf"), F.col("steps"))).withColumn("other", manifest.fold(F.col("seen"), F.col("steps"))).collect()
    want = brute.manifest([(k, g, brute.leaf((k, g, t))) for k, g, t in rows])
    assert sorted(((r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], steps(r)) for r in got), key=repr) == want
    assert all(r["own"] == r["root"] for r in got)
    assert all((r["other"] == r["root"]) == (r["seen"] == r["leaf"]) == (r["doc_id"] is None or r["doc_id"] % 2 == 1) for r in got)


def test_small_manifests(spark):
    df = spark.createDataFrame([(1, "a", "text " * 200_000)], "doc_id long, source string, text string")
    leaf = manifest.leaf_hash([F.col("text")])
    (row,) = manifest.manifest(df, leaf).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == brute.leaf(["text " * 200_000]) and row["steps"] == [] and row["seen"] == row["leaf"]
    assert manifest.manifest(df.limit(0), leaf).collect() == []
