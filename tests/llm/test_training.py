"""Packing, fill-in-the-middle and the conversation trie, on given tables and odd ones."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareloom.llm import fill_in_middle as fim
from fareloom.llm import packing, prefix_trie

SF = "/root/testdata/sf0.01"
WORDS = public_tokenizers.path("word_bpe_49k.json")


# packing


def library_pieces(docs, capacity):
    tokenizer = Tokenizer.from_file(WORDS)
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            yield doc_id, k, start, len(part), zlib.crc32(part.tobytes())


def check_places(rows, capacity):
    """Sequences without gaps and within the capacity; returns how many there are."""
    found = defaultdict(list)
    for r in rows:
        found[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in found.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(found)


def test_pieces_and_sequences_of_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = packing.op11_grouping_genetic(spark, SF).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == Counter(library_pieces(docs, 2048))
    tokens = sum(r.length for r in rows)
    assert check_places(rows, 2048) <= 1 + -(-tokens // 2048)


def test_packing_of_odd_documents(spark, documents):
    """Null, empty, repeated and long texts, special tokens, marks and words that are not remembered."""
    texts = ["", None, "a <|endoftext|> b <|startoftext|>", "İ J̌ ΣΑΣ é 가 'S 12x", "   x", "word " * 3000, "z" * 500 + " z"]
    docs = [*enumerate(texts), (3, texts[3]), (None, "no id")]
    rows = packing.pack_documents(documents(*docs), WORDS, capacity=64, block=4).collect()
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == Counter(library_pieces(docs, 64))
    check_places(rows, 64)
    assert packing.pack_documents(documents(), WORDS).count() == 0


def test_texts_are_tokenised_in_stretches(monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 50)
    text = f"Some wörds,\x1cand <|endoftext|> more\u2003of\x85THEM'S {'long' * 30} ΑΣ x̌\tJ̌ tokens " * 40
    want = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    for remembered in (1 << 20, 2000, 1):
        monkeypatch.setattr(packing, "REMEMBERED", remembered)
        ids = packing.WordIds(WORDS)
        assert np.frombuffer(b"".join(ids.stretches(text)), "<u4").tolist() == want
        assert np.frombuffer(b"".join(ids.stretches(text)), "<u4").tolist() == want
    pieces = list(packing.cut(ids.stretches(text), 0, 16))
    assert np.frombuffer(b"".join(pieces), "<u4").tolist() == [*want, 0] and {len(p) for p in pieces[:-1]} == {64}


def test_sequences_hold_the_ids_of_their_pieces(documents):
    packed = packing.pack_documents(documents((1, "one two three"), (2, "four"), (3, "five six " * 30)), WORDS, 16, with_ids=True)
    pieces = packed.collect()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in pieces:
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert sum(map(len, whole.values())) == sum(r["length"] for r in pieces)


@pytest.mark.parametrize("seed", range(5))
def test_children_hold_every_piece_once(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 100) for _ in range(60)]
    known = packing.first_packings(lengths, 100, rng, 4)
    for _ in range(20):
        bred = packing.child(*rng.sample(known, 2), lengths, 100, rng)
        assert sorted(i for b in bred[0] for i in b) == list(range(60))
        assert bred[1] == [100 - sum(lengths[i] for i in b) for b in bred[0]] and min(bred[1]) >= 0
        known[rng.randrange(4)] = bred
    genes = packing.as_genes(known[0], 60).tolist()
    assert packing.as_genes(packing.as_packing(genes, lengths, 100), 60).tolist() == genes


def test_evolution_mends_what_best_fit_leaves():
    """Best fit by size needs 5 bins for these; 4 hold them exactly."""
    lengths = [44, 36, 20, 41, 31, 28, 37, 35, 28, 40, 33, 27]
    rng = random.Random(3)
    first: packing.Packing = ([], [])
    packing.best_fit(sorted(range(12), key=lengths.__getitem__, reverse=True), lengths, first, 100)
    ranked = packing.evolve(packing.first_packings(lengths, 100, rng, 8), lengths, 100, rng, 4000)
    assert len(first[0]) == 5 and len(ranked[0][0]) == 4 == packing.least_bins(lengths, 100)


def test_open_bins_meet_in_later_rounds(spark):
    """Many small blocks leave many open bins (alone they need 1.07 times the least number); later rounds fill most of them."""
    rng = random.Random(1)
    rows = [(i, rng.randint(1, 100)) for i in range(4000)]
    pieces = spark.createDataFrame(rows, "rid long, length long")
    placed = {r.rid: r for r in packing.pack_pieces(pieces, 100, 64).collect()}
    found = [{"sequence_id": placed[i].sequence_id, "offset": placed[i].offset, "length": n} for i, n in rows]
    least = packing.least_bins([n for _, n in rows], 100)
    assert len(placed) == 4000 and check_places(found, 100) <= 1.05 * least


def test_pieces_that_never_share_a_bin(spark):
    pieces = spark.createDataFrame([(i, 60) for i in range(500)], "rid long, length long")
    placed = packing.pack_pieces(pieces, 100, 64).collect()
    assert len({r.sequence_id for r in placed}) == len(placed) == 500


# fill-in-the-middle


@pytest.mark.parametrize("n", [0, 1, 4, 5, 63, 1000])
def test_skip_list_reaches_every_rank(n):
    widths = [random.Random(n).randint(1, 9) for _ in range(n)]
    units = fim.SkipList(widths)
    assert [units.seek(r) for r in range(n + 1)] == [sum(widths[:r]) for r in range(n + 1)]
    for wrong in (-1, n + 1):
        with pytest.raises(IndexError):
            units.seek(wrong)


def test_lanes_join_the_links_below():
    widths = list(range(1, 2001))
    units = fim.SkipList(widths)
    assert len(units.lanes) > 3 and all(len(b) < len(a) for a, b in zip(units.lanes, units.lanes[1:], strict=False))
    assert all((sum(u for u, _ in lane), sum(p for _, p in lane)) == (2000, sum(widths)) for lane in units.lanes)


def plain_middle(doc_id, text, percent=100, spm=50):
    text = text or ""
    lines = fim.LINE.findall(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(lines), "plain", None, None, text
    form = "spm" if h[3] % 100 < spm else "psm"
    return len(lines), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def test_cuts_of_odd_documents(documents):
    texts = ["", None, "\n\n\n", "é\nü\U0001f600\n", "no line end", "a\n<M>\nb", "x" * 100_000, "l\n" * 20_000, "a\r\nb c\n"]
    docs = [*enumerate(texts), (3, texts[3]), (None, "x\ny\nz\n")]
    for percent, spm in ((100, 50), (60, 20)):
        rows = fim.fill_in_middle(documents(*docs), percent, spm).collect()
        got = sorted(((r["row"]["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows), key=repr)
        assert got == sorted([(i, *plain_middle(i, t, percent, spm)) for i, t in docs], key=repr)
    assert fim.fill_in_middle(documents()).count() == 0


def test_texts_come_back_from_output_and_form(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in fim.op12_indexable_skip_list(spark, SF).collect():
        assert r.restored_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


# conversation trie


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = (text or "").encode()
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(said).hexdigest(), said))
    paths = {}
    for c, said in convs.items():
        said.sort()
    for c, said in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = [(x[2], x[4]) for x in [*convs.get(c - c % 5, [])[:h], *said[h:]]]
    members, children = defaultdict(list), Counter()
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children.update(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(m) - 1) * (len(n[-1][1]) if n else 0)
    out = []
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(n))
        parent = min(members[n[:-1]]) if n else None
        out.append((min(m), len(n), parent, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(turns, **how):
    found = prefix_trie.prefix_trie(turns, **how).collect()
    names = ("conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256")
    return sorted([tuple(r[n] for n in names) for r in found], key=repr)


TURNS = "conv_id long, turn long, role string, text string, depth string, node long, len string, comp long"


@pytest.fixture
def turns(spark):
    return lambda rows: spark.createDataFrame([(*r, "d", 7, "l", 7) for r in rows], TURNS)


def test_trie_of_odd_conversations(turns):
    """Null and repeated turns, conversations without turns of their own, an absent first conversation, no id."""
    rows = [(c, t, "ab"[t % 2], f"t{t % 3}{'é' * (c % 2)}") for c in range(1, 60) for t in range(c % 7 + 1)]
    rows += [(3, None, None, None), (3, None, "a", None), (8, 1, "b", "t1"), (8, 1, "b", "t1"), (None, 0, "a", "x"), (70, 0, "", "")]
    assert trie_rows(turns(rows)) == plain_trie(rows)
    assert trie_rows(turns([])) == []


@pytest.mark.parametrize("limit", [1, 12, 100])
def test_components_split_by_joins(turns, monkeypatch, limit):
    """A long chain, a star and a bushy trie; short segments and chunks."""
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rng = random.Random(limit)
    rows = [(100, t, "a", f"c{t}") for t in range(60)]
    rows += [(c, t, "ab"[t % 2], rng.choice("xyz") if t else "x") for c in range(5, 45) for t in range(rng.randint(1, 6))]
    rows += [(c, 0, "a", f"s{c}") for c in range(200, 230)] + [(c, 0, "a", "same") for c in range(300, 330)]
    assert trie_rows(turns(rows), limit=limit) == plain_trie(rows)


@pytest.mark.parametrize("seed", range(4))
def test_decomposition_sums_subtrees(seed):
    rng = random.Random(seed)
    reach = (1, 3, 50, 500)[seed]  # from a chain to a bush
    parents = [-1, *(rng.randrange(max(0, i - reach), i) for i in range(1, 400))]
    values = [rng.randrange(-5, 100) for _ in parents]
    want = values[:]
    for i in range(399, 0, -1):
        want[parents[i]] += want[i]
    assert prefix_trie.decompose(np.array(parents), [np.array(values)])[0].tolist() == want
