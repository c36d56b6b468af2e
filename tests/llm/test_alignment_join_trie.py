"""Tokenizer alignment, the shingle join and the prefix trie against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import alignment, gramjoin, prefixtrie
from strata.llm.queries import PIECES, VOCABULARY

SPACE = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string"


def made_words(seed, count):
    pick = random.Random(seed)
    return ["".join(pick.choice("abcdeéfgh") for _ in range(pick.randrange(2, 9))) for _ in range(count)]


# ---- alignment ----------------------------------------------------------------


def token_bytes():
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    visible = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    letters = {chr(x): x for x in visible} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in visible)}

    def both(text):
        left = a.encode(" " + text, add_special_tokens=False).ids
        right = b.encode(text)
        spelled = [bytes(letters[c] for c in a.id_to_token(i)) for i in left]
        pieces = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in right]
        return left, spelled, right, pieces

    return both


def aligned_by_hand(texts):
    """Every A token against every B token of a text, by their byte ranges."""
    both, kept, counts = token_bytes(), [], Counter()
    for text in texts:
        if not text:
            kept.append(None)
            continue
        a, abytes, b, bbytes = both(text)
        whole = (" " + text).encode()
        if b"".join(abytes) != whole or b"".join(bbytes) != whole:
            kept.append(None)
            continue
        ranges = []
        for parts in (abytes, bbytes):
            ends = np.cumsum([len(p) for p in parts])
            ranges.append(list(zip((ends - [len(p) for p in parts]).tolist(), ends.tolist())))
        links = [(a[i], b[j]) for i, (s, e) in enumerate(ranges[0]) for j, (t, u) in enumerate(ranges[1]) if s < u and t < e]
        cuts = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            sides = [[t for t, (_, e) in zip(tokens, r) if low < e <= high] for tokens, r in ((a, ranges[0]), (b, ranges[1]))]
            groups.append("|".join(",".join(map(str, s)) for s in sides))
        kept.append((len(a), len(b), groups, links))
        counts.update(set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    want = []
    for k in kept:
        if k is None:
            want.append((0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(counts[p] == most[p[0]] for p in k[3])
            want.append((k[0], k[1], len(k[2]), len(k[3]), best, sum(counts[p] for p in k[3]), ";".join(k[2])))
    return want, counts, Counter(p for k in kept if k for p in k[3])


@pytest.fixture(scope="module")
def texts():
    line = " ".join(made_words(1, 60))
    return [
        None, "", " ", "a", "  two  blanks ", "x\ny \n\n z\t", "<|endoftext|> <s> <0x41> </s>", "日本語 テキスト　全角 空白", "naïve café … — ’s don't",
        "é combining", "emoji 🎉🎉 done", line, line, line.upper(), "tail space ", "\x00 nul \x7f del", "a" * 700, "word " * 300, "١٢٣ ½ ﬁ",
        *[" ".join(made_words(50 + n, 30)) for n in range(12)],
    ]


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.mark.parametrize("container", [alignment.CONTAINER_TEXTS, 4])
def test_alignment(spark, texts, monkeypatch, container):
    monkeypatch.setattr(alignment, "CONTAINER_TEXTS", container)
    monkeypatch.setattr(alignment, "SEGMENT_PAIRS", 100)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumns({"n_a": F.lit("clash"), "groups": F.lit("clash"), "lang": F.lit("en")})
    got = alignment.align(docs.repartition(1), VOCABULARY, PIECES)
    assert set(got.columns) == {"doc_id", "lang", "groups", *FIGURES}
    want, counts, times = aligned_by_hand(texts)
    found = {r["doc_id"]: (*[r[f] for f in FIGURES], r["groups"]) for r in got.collect()}
    assert found == dict(enumerate(want))
    pairs = alignment.pair_counts(docs, VOCABULARY, PIECES).collect()
    assert {(r["a_id"], r["b_id"]): (r["n_docs"], r["n_links"]) for r in pairs} == {p: (n, times[p]) for p, n in counts.items()}
    digests = alignment.align(docs, VOCABULARY, PIECES, digests=True).select("doc_id", "groups_sha256").collect()
    assert {r[0]: r[1] for r in digests} == {n: hashlib.sha256(w[-1].encode()).hexdigest() if w[0] else "" for n, w in enumerate(want)}


def test_words_of_several_blocks_and_forgetting(spark, monkeypatch):
    monkeypatch.setattr(alignment, "MEMORY_BYTES", 2_000)
    monkeypatch.setattr(alignment, "RUN_BYTES", 300)
    texts = [" ".join(made_words(n, 400)) for n in range(6)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)] + [(9, None)], DOCS).repartition(2)
    want, _, _ = aligned_by_hand(texts)
    got = alignment.align(docs, VOCABULARY, PIECES).collect()
    assert {r["doc_id"]: (*[r[f] for f in FIGURES], r["groups"]) for r in got if r["doc_id"] < 9} == dict(enumerate(want))


def test_a_text_of_several_megabytes_is_aligned_whole():
    words = alignment.Words(*alignment._sides(alignment._definitions(VOCABULARY, PIECES)))
    text = " ".join(made_words(3, 400_000)).encode()
    offsets = np.array([0, len(text)])
    figures, groups, pairs, owner = alignment.aligned_block(words, np.frombuffer(text, np.uint8), offsets)
    assert len(text) > 2 << 20 and len(pairs) == figures[0, 3] and set(owner.tolist()) == {0}
    assert groups[0].count(b";") + 1 == figures[0, 2]
    assert figures[0, 3] == figures[0, 0] + figures[0, 1] - figures[0, 2]


def test_compressed_bitmaps_come_back():
    pick = np.random.default_rng(4)
    held = alignment.Container()
    want = Counter()
    for _ in range(5):
        owner = pick.integers(0, 300, 20_000)
        pairs = (pick.zipf(1.3, 20_000) % 900).astype(np.int64)
        want.update(zip(pairs.tolist(), (owner + held.n_texts).tolist()))
        held.add(300, pairs, owner)
    got = Counter()
    for pairs, counts, docs, planes in held.segments():
        pair, text, times = alignment.unpacked(counts, docs, planes, held.n_texts)
        got.update(dict(zip(zip(pairs[pair].tolist(), text.tolist()), times.tolist())))
    assert got == want


def test_alignment_of_an_empty_table(spark):
    got = alignment.align(spark.createDataFrame([], DOCS), VOCABULARY, PIECES, digests=True)
    assert got.count() == 0 and got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


# ---- join ---------------------------------------------------------------------


def shingles(text):
    words = SPACE.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def joined_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for n, x in enumerate(sets):
        for m in range(n):
            both = len(x & sets[m])
            if both and 100 * both >= 85 * (len(x) + len(sets[m]) - both):
                root[top(n)] = top(m)
    least = {}
    for n, (key, _) in enumerate(rows):
        if key is not None:
            least[top(n)] = min(key, least.get(top(n), key))
    return Counter((key, len(sets[n]), least.get(top(n))) for n, (key, _) in enumerate(rows))


@pytest.fixture(scope="module")
def near_copies():
    pick = random.Random(8)
    rows = [(1000 + k, t) for k, t in enumerate([None, "", " \n", "One", "one", "one two three", "ONE two  three", "a b c d", "a b c d e", "É é", "é É", " ".join(made_words(2, 9000))])]
    for family in range(8):
        size = pick.choice([5, 12, 40, 90, 300])
        base = made_words(family, size)
        for copy in range(14):
            own = list(base)
            for _ in range(pick.randrange(0, max(2, size // 25))):
                own[pick.randrange(len(own))] = pick.choice(["edit", "other", "Edit"])
            if pick.random() < 0.3:
                own += made_words(900 + copy, size // 12)
            rows.append((100 * family + copy, " ".join(own)))
    boiler = " ".join(made_words(77, 40))
    rows += [(5000 + n, boiler + " " + " ".join(made_words(3000 + n, 30))) for n in range(40)]
    rows += [(None, "no key here at all"), (None, "no key here at all"), (3, rows[20][1]), rows[30]]
    return rows


def test_join(spark, near_copies):
    docs = spark.createDataFrame(near_copies, DOCS).withColumns({"n_shingles": F.lit("clash"), "component_id": F.lit("clash"), "lang": F.lit("x")})
    got = gramjoin.join(docs)
    assert set(got.columns) == {"doc_id", "text", "lang", "n_shingles", "component_id"}
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == joined_by_hand(near_copies)


def test_join_with_tiles_dealt_into_parts(spark, near_copies, monkeypatch):
    monkeypatch.setattr(gramjoin, "TILE_MEMBERS", 4)
    got = gramjoin.join(spark.createDataFrame(near_copies, DOCS), keep_text=False)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == joined_by_hand(near_copies)


def test_similar_sets_share_a_tile_and_bitmaps_bound_the_overlap():
    """For sets right at the bound, in both orders and over the borders of bands."""
    pick = np.random.default_rng(3)
    for size in [*range(1, 80), 101, 163, 262, 263, 420, 700, 1500]:
        for larger in sorted({size, int(size / 0.85), (size + int(size / 0.85)) // 2}):
            # the least overlap that still links
            both = next(b for b in range(1, size + 1) if 100 * b >= 85 * (size + larger - b)) if 100 * size >= 85 * larger else None
            if both is None:
                continue
            pool = np.unique(pick.integers(1, 2**63, size + larger + 9).astype(np.uint64))
            x, y = np.sort(pool[:size]), np.sort(np.r_[pool[:both], pool[size : size + larger - both]])
            texts, grams = np.repeat([0, 1], [len(x), len(y)]), np.r_[x, y]
            sizes, bands = np.array([len(x), len(y)]), gramjoin.Bands(larger)
            owner, tile = gramjoin.tiles_of(texts, grams, sizes, bands)
            assert set(tile[owner == 0].tolist()) & set(tile[owner == 1].tolist()), (size, larger)
            maps = gramjoin.bitmaps_of(texts, grams, sizes, bands)
            width = min(map(len, maps))
            bits = int(np.bitwise_count(gramjoin.folded(maps[0], width) ^ gramjoin.folded(maps[1], width)).sum())
            assert gramjoin.most_overlap(sizes[0], sizes[1], np.int64(bits)) >= both
            assert gramjoin.enough(np.int64(both), sizes.sum()) and not gramjoin.enough(np.int64(both - 1), sizes.sum())


def test_join_of_an_empty_table(spark):
    assert gramjoin.join(spark.createDataFrame([], DOCS)).count() == 0


# ---- trie ---------------------------------------------------------------------

TURNS = "conv_id long, turn int, role string, text string"


def rebuilt_by_hand(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(many)] for c, many in own.items()}
    whole = {}
    for c, many in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + many[h:]
    return whole


def trie_by_hand(whole):
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    nodes = []
    for node, inside in members.items():
        under = [n for n in members if n[: len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        leaves = [n for n in under if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in under)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n)
        ends = ",".join(map(str, sorted(c for c in inside if len(whole[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        nodes.append((min(inside), len(node), parent, len(inside), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(nodes)


@pytest.fixture(scope="module")
def turns():
    pick = random.Random(6)
    rows = []
    for conv in [*range(0, 46), 60, 61, 77, 1003, 1004]:
        for turn in range(pick.randrange(1, 9)):
            rows.append((conv, turn if pick.random() < 0.95 else None, pick.choice(["user", "assistant", None]), pick.choice(["hi", "é", "", None, "a much longer text"])))
    # groups of equal conversations, a repeated row, ties of turns, and rows of no conversation
    rows += [(200 + k, t, "user", f"same {t}") for k in range(10) for t in range(4)]
    rows += [(210, 0, "user", "x"), (210, 0, "user", "x"), (210, 0, "assistant", "x"), (None, 0, "user", "lost"), (211, None, None, None)]
    pick.shuffle(rows)
    return rows


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("block", [prefixtrie.BLOCK, 4, 1])
def test_trie(spark, turns, monkeypatch, block):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    monkeypatch.setattr(prefixtrie, "ENDS_BLOCK", 3)
    df = spark.createDataFrame(turns, TURNS).withColumns({"depth": F.lit("clash"), "pos": F.lit("clash")})
    got = prefixtrie.trie(prefixtrie.reassembled(df))
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == trie_by_hand(rebuilt_by_hand(turns))


def test_trie_of_long_conversations(spark, monkeypatch):
    """Deeper than a block, with borders of blocks inside shared prefixes."""
    monkeypatch.setattr(prefixtrie, "BLOCK", 8)
    shared = [("user", f"t{k}") for k in range(70)]
    whole = {c: shared[: 5 + 13 * c] + [("assistant", f"own {c} {k}") for k in range(c)] for c in range(6)} | {9: []}
    rows = [(c, d + 1, *turn) for c, many in whole.items() for d, turn in enumerate(many)] + [(c, 0, "", "") for c in whole]
    got = prefixtrie.trie(spark.createDataFrame(rows, "conv long, pos long, role string, text string"))
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == trie_by_hand(whole)


def test_trie_of_an_empty_table(spark):
    got = prefixtrie.trie(prefixtrie.reassembled(spark.createDataFrame([], TURNS)))
    assert got.columns == COLUMNS and got.count() == 0
