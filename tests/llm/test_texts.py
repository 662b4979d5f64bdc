"""Scores, token counts, decontamination and near-duplicates against plain Python, on given tables and odd ones."""

from __future__ import annotations

import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareloom.llm import bpe_counts, lattice_lm, near_dedup
from fareloom.llm.common import byte_words
from fareloom.llm.decontaminate import SuffixAutomaton, decontaminate, mark_spans, op6_suffix_automaton, word_parts
from tests.llm import plain

SF = "/root/testdata/sf0.01"
PIECES, MERGES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json"))
PROSE = " ".join(f"word{i % 97} and{i % 31}" for i in range(120))


def texts(spark, table="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{table}.parquet").select("*").collect()]


# scores


def test_scores_equal_the_base_formula(spark, documents):
    docs = [(i, t) for i, t in enumerate(["a b a", "The cat", None, "", "a zebra", "a b a", "\u00c9t\u00e9 \x00"] * 3)]
    rows = {r["id"]: r for r in lattice_lm.score_documents(documents(*docs), PIECES).collect()}
    train = [t for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in byte_words(t))
    total, distinct = sum(counts.values()) + len(train), len(counts) + 1
    assert len(rows) == len(docs)
    for i, t in docs:
        seen = [counts[w] for w in byte_words(t)] + [len(train)]
        base = sum(math.log10((c + 1) / (total + distinct + 1)) for c in seen)
        row = rows[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(seen), sum(c > 0 for c in seen), total)
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert row["base_score"] == pytest.approx(base) and row["score"] < 0


def test_the_recursion_sums_all_segmentations():
    weights = {b" a": 0.2, b"a": 0.3, b"b": 0.1, b"ab": 0.15, b" ": 0.05, b" ab": 0.2}
    pieces = lattice_lm.Pieces.of(list(weights), np.array(list(weights.values())))
    word = b" abab"
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(word[start:i])
                start = i
        total += math.prod(weights.get(p, 0.0) for p in parts)
    found, uses = lattice_lm.word_lattices([word[1:]], pieces, np.array([2.0]))
    assert found[0] == pytest.approx(math.log(total))
    slow, slow_uses = lattice_lm.long_lattice(word, pieces, 2.0)
    assert slow == pytest.approx(found[0]) and np.allclose(uses, slow_uses)


def test_long_words_and_empty_tables(documents):
    rows = lattice_lm.score_documents(documents((1, "x" * 3000), (1, "x" * 3000), (None, "y")), PIECES).collect()
    assert len(rows) == 3 and all(math.isfinite(r["score"]) for r in rows)
    assert lattice_lm.score_documents(documents(), PIECES).collect() == []


def test_long_words_are_joined_not_sent(documents, monkeypatch):
    """Words of any number and size leave the driver alone, a frequent long one is dealt, and no result changes."""
    sent, make = [], lattice_lm.score_frequent
    monkeypatch.setattr(lattice_lm, "score_frequent", lambda table: sent.append(table.value[0]) or make(table))
    dealt, deal = [], lattice_lm.with_parts
    monkeypatch.setattr(lattice_lm, "with_parts", lambda rows, words: dealt.append(words) or deal(rows, words))
    docs = documents(*[(i, f"short {'y' * 64} {'z' * 65} {'q' * 300 + str(i % 3)} {'u' * 100 + str(i)}") for i in range(60)])
    found = sorted(tuple(r) for r in lattice_lm.score_documents(docs, PIECES).collect())
    assert sorted(sent[0]) == [b"short", b"y" * 64]
    parts = [r["parts"] for r in dealt[0].collect()]
    train = sum(not r[1] for r in found)
    assert max(parts) == train and len(parts) == 4  # the words of one document hold less than two tokens
    monkeypatch.setattr(lattice_lm, "SHORT", 1 << 20)
    wanted = sorted(tuple(r) for r in lattice_lm.score_documents(docs, PIECES).collect())
    assert len(sent[1]) > 60 and len(found) == len(wanted) == 60
    for a, b in zip(found, wanted, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_whole_words_and_paths_share_the_probability():
    """Over all words the sum is one: the counted ones by their edges and paths, the rest by paths alone."""
    paths = {b"a": 0.25, b"b": 0.25, b"ab": 0.125, b"unmet": 0.375}
    counts = {b"a": 1.0, b"b": 2.0, b"ab": 5.0, b"unmet": 0.0}
    whole = lattice_lm.WholeWords.of(8, 3, 1, 1)
    found = np.exp(whole.join(np.array(list(counts.values())), np.log(list(paths.values()))))
    assert whole.discount == pytest.approx(1 / 3) and found.sum() == pytest.approx(1)
    wanted = [(max(c - 1 / 3, 0) + 2 * p) / 9 for c, p in zip(counts.values(), paths.values(), strict=True)]
    assert found == pytest.approx(wanted)
    nothing = lattice_lm.WholeWords.of(0, 0, 0, 0)
    assert nothing.join(np.zeros(1), np.array([-3.0])) == pytest.approx(-3.0)


def test_training_lowers_the_held_out_surprise(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def held_out(rounds):
        rows = lattice_lm.score_documents(docs, PIECES, rounds=rounds).where("held_out").collect()
        return sum(r["score"] for r in rows)

    once, twice = held_out(1), held_out(2)
    monkeypatch.setattr(lattice_lm.WholeWords, "join", lambda self, counts, paths: paths)
    assert 1.1 * held_out(2) < once < twice < 0


# token counts


def test_counts_equal_the_library():
    library, mine = Tokenizer.from_file(MERGES), bpe_counts.TokenCounter(MERGES)
    draw = random.Random(3)
    parts = list("aBz19 _!'\t\x1c\x85\u00e9\u0301\u03a3\u0130\u212a\u4e2d\u00bd\u3000\u200b") + ["<|endoftext|>", "<|", "'ll", "\U0001f600", "the "]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 15)))
        assert mine.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_counts_of_given_and_odd_texts(spark, documents):
    library = Tokenizer.from_file(MERGES)
    odd = documents((1, None), (2, ""), (3, "ab" * 20_000), (None, "a"), (3, "ab" * 20_000))
    for docs in (spark.read.parquet(f"{SF}/documents.parquet").limit(100), odd):
        wanted = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
        found = [tuple(r) for r in bpe_counts.token_counts(docs, MERGES).collect()]
        assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert bpe_counts.token_counts(documents(), MERGES).count() == 0


# decontamination


def test_hits_equal_plain_windows(spark):
    docs, items = [(r[0], r[1]) for r in texts(spark)], texts(spark, "benchmark")
    found = {r.doc_id: tuple(r)[1:] for r in op6_suffix_automaton(spark, SF).collect()}
    assert found == plain.leaks(docs, items)


def test_random_hits_and_blocks(spark, documents):
    draw = random.Random(4)
    say = lambda n: " ".join(draw.choices("abcd", k=n))
    docs = [(i, say(draw.randint(0, 60))) for i in range(60)]
    items = [(i, say(draw.randint(0, 14))) for i in range(12)] + [(99, None), (3, "A-b,c D a b")]
    table = spark.createDataFrame(items, "item_id long, text string")
    wanted = plain.leaks(docs, items)
    for block_bytes in (1 << 20, 40):
        for r in mark_spans(documents(*docs), table, block_bytes=block_bytes).collect():
            n = sum(s["end"] - s["start"] for s in r["spans"])
            assert (r["n_words"], n, len(r["items"])) == wanted[r["row"]["doc_id"]][:3]


def test_a_plan_holds_one_automaton_at_a_time(spark, documents):
    """Blocks are stored in between: the last plan runs one pass, whatever their number."""
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i} d e f g h i j k l") for i in range(40)], "item_id long, text string")
    marked = mark_spans(documents((1, "x a3 b3 c3 d e f g h i j k l y")), items, block_bytes=200)
    assert marked._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [(r["items"], [(s["start"], s["end"]) for s in r["spans"]]) for r in marked.collect()][0][1] == [(1, 13)]


def test_an_item_larger_than_a_block_is_split_with_overlap(spark, documents):
    draw = random.Random(8)
    item = " ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(3000))
    words = item.split()
    docs = [(i, "start " + " ".join(words[k : k + 10]) + " end") for i, k in enumerate(range(0, 2990, 7))]
    items = spark.createDataFrame([(1, item), (2, "short one")], "item_id long, text string")
    for block_bytes in (1 << 20, 600):
        marked = mark_spans(documents(*docs), items, block_bytes=block_bytes, keep_text=False)
        assert all(r["items"] == ["1"] and r["body"] is None and [(s["start"], s["end"]) for s in r["spans"]] == [(1, 11)] for r in marked.collect())


def test_parts_overlap_and_cover():
    words = [b"w" * n for n in (3, 9, 1, 1, 40, 2, 2, 2, 7, 7, 7, 1)]
    for size in (1, 10, 25, 1000):
        parts = list(word_parts(words, size, 2))
        assert parts[0][0] == 0 and parts[-1][1] == len(words)
        assert all(a[1] > b[0] >= a[1] - 2 and b[1] > a[1] for a, b in zip(parts, parts[1:], strict=False))
    assert list(word_parts([], 10, 2)) == []


def test_an_automaton_is_small():
    """Some 30 bytes a state and what its words need, not a table of edges and sets for each."""
    draw = random.Random(6)
    vocabulary = [f"word{i}".encode() for i in range(3000)]
    items = [(str(i), b" ".join(draw.choices(vocabulary, k=300)), 300) for i in range(300)]
    size = sum(len(raw) for _, raw, _ in items)
    tracemalloc.start()
    automaton = SuffixAutomaton(items, 10, 1.0)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(automaton.link) > 90_000 and held < 40 * size


def test_cutting_leaves_no_hit_and_clean_texts_alone(spark, documents):
    passage = " ".join(f"p{i}" for i in range(12))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = documents((1, f"Before, {passage.upper()}; after \u00e9."), (2, passage), (3, PROSE), (4, None), (5, ""), (5, ""))
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    rows = sorted((r.doc_id, r.text, r.n_chars) for r in left.collect() if r.text is not None)
    assert rows == [(1, "Before, ; after \u00e9.", 18), (3, PROSE, len(PROSE)), (5, "", 0), (5, "", 0)]
    assert left.where("doc_id = 4 AND text IS NULL").count() == 1
    assert decontaminate(docs, items.limit(0)).count() == docs.count()
    assert decontaminate(documents(), items).count() == 0


# near-duplicates


def test_classes_equal_plain_python(spark):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.op7_minmax_hash(spark, SF).collect()}
    assert found == plain.near_classes([(r[0], r[1]) for r in texts(spark)], 3, 85)


def test_chains_of_edited_copies(documents, monkeypatch):
    """A group whose members are alike to very different degrees, closed in blocks smaller than the group."""
    monkeypatch.setattr(near_dedup, "HELD", 8)
    monkeypatch.setattr(near_dedup, "STREAMED", 16)
    draw = random.Random(5)
    words = [f"w{i}" for i in range(80)]
    docs = []
    for i in range(90):
        copy = list(words)
        for _ in range(draw.randint(0, 6)):
            copy[draw.randrange(80)] = f"x{draw.randrange(1000)}"
        docs.append((i, " ".join(copy)))
    found = near_dedup.near_duplicates(documents(*docs)).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain.near_classes(docs, 3, 85)


def test_odd_documents_and_the_one_that_stays(documents):
    docs = documents((9, PROSE), (4, PROSE.upper()), (4, PROSE.upper()), (None, PROSE), (5, None), (6, ""), (6, ""), (7, " \n"), (8, "two words"), (None, "alone here"))
    found = sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs).collect()), key=repr)
    sizes = {i: n for i, n, _ in found}
    assert [c for i, _, c in found if i in (9, 4)] == [4, 4, 4]
    assert (None, sizes[9], 4) in found and (None, 1, None) in found
    assert [(i, n, c) for i, n, c in found if i in (5, 6, 7, 8)] == [(5, 0, 5), (6, 0, 6), (6, 0, 6), (7, 0, 7), (8, 1, 8)]
    left = near_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in left.collect()) == [
        (False, 4, PROSE.upper()), (False, 5, ""), (False, 6, ""), (False, 6, ""), (False, 7, " \n"), (False, 8, "two words"), (True, 0, "alone here"),
    ]
    assert near_dedup.near_duplicates(documents()).count() == 0 and near_dedup.deduplicate(documents()).count() == 0
