"""The text operators against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import bagminhash, components, contamination, language, lexicon, packing, passages, quality, repeats, rules, sampling, warc
from strata.llm.queries import VOCABULARY

SPACE = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return SPACE.findall(text or "")


def made_words(seed, count):
    pick = random.Random(seed)
    return ["".join(pick.choice("abcdeéfgh") for _ in range(pick.randrange(2, 9))) for _ in range(count)]


def odd_texts():
    line = " ".join(made_words(1, 70))
    near = line.split()
    near[30] = "changed"
    return [None, "", " \n ", "one", "one two three", "a" * 900, "ab" * 400, line, line, line + "\n" + line, " ".join(near), "é " * 300, "x \x00 <|endoftext|> y", "\n".join(["same line here"] * 40), " ".join(made_words(9, 6000))]


@pytest.fixture(scope="module")
def docs(spark):
    texts = odd_texts()
    pick = random.Random(5)
    shared = [made_words(k, 80) for k in range(5)]
    for n in range(60):
        parts = []
        for _ in range(pick.randrange(1, 5)):
            own = list(pick.choice(shared)) if pick.random() < 0.6 else made_words(1000 + n * 7 + len(parts), pick.randrange(1, 90))
            if pick.random() < 0.4:
                own[pick.randrange(len(own))] = "edit"
            parts.append(" ".join(own[pick.randrange(0, 9) :]))
        texts.append(" ".join(parts))
    rows = [(n, t, "en" if n % 2 else "fr", None if n % 3 else "s", len(t) if t else 0) for n, t in enumerate(texts)]
    rows.append(rows[20])
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df, *names):
    """The table with extra columns named like results."""
    return df.withColumns({n: F.lit("clash") for n in names})


def repeated_bytes(texts, length):
    seen = defaultdict(list)
    raws = [(t or "").encode() for t in texts]
    for n, raw in enumerate(raws):
        for at in range(len(raw) - length + 1):
            seen[raw[at : at + length]].append((n, at))
    flags = [np.zeros(len(r), bool) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for n, at in places:
                flags[n][at : at + length] = True
    return raws, flags


@pytest.mark.parametrize("bucket", [repeats.BUCKET_PIECES, 3])
def test_repeats(docs, bucket):
    df = clashing(docs, "n_bytes", "kept_sha256")
    got = repeats.remove_repeats(df, bucket=bucket).collect()
    raws, flags = repeated_bytes([r.text for r in docs.collect()], 200)
    want = []
    for raw, gone in zip(raws, flags):
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        want.append((len(raw), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter(want)
    assert sum(w[1] for w in want) > 1000


def test_repeats_indexed_in_parts(docs, monkeypatch):
    pieces = Counter()
    for row in docs.collect():
        raw = (row.text or "").encode()
        data = np.frombuffer(raw, np.uint8)
        for first, count in zip(*[x.tolist() for x in repeats.pieces_of(data, np.array([0, len(raw)]), 200, 48)[2:4]]):
            pieces[raw[first : first + count + 199]] += 1
    texts, weights = list(pieces), np.array(list(pieces.values()))
    whole = repeats.repeated_strings(texts, weights, 200)
    monkeypatch.setattr(repeats, "INDEX_BYTES", 3000)
    parts = repeats.repeated_in_parts(texts, weights, 200, 48)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_only_tied_suffixes_are_ranked_again(monkeypatch):
    pick = random.Random(8)
    shared = bytes(pick.choices(range(1, 255), k=700))
    pieces = [shared[:500], shared[100:], bytes(pick.choices(range(1, 255), k=3000)), b"a" * 900, b"ab" * 400, b"short", shared[300:] + b"b" * 300]
    sorted_keys = []
    ordered = repeats._ordered
    monkeypatch.setattr(repeats, "_ordered", lambda keys, bits: sorted_keys.append(len(keys)) or ordered(keys, bits))
    found = repeats.repeated_strings(pieces, np.array([1, 1, 1, 1, 1, 1, 2]), 200)
    strings = Counter(p[at : at + 200] for p, w in zip(pieces, (1, 1, 1, 1, 1, 1, 2)) for at in range(len(p) - 199) for _ in range(w))
    assert [f.tolist() for f in found] == [[strings[p[at : at + 200]] > 1 for at in range(len(p) - 199)] for p in pieces]
    # the random bytes are told apart by the first sort
    assert sorted_keys[0] == sum(map(len, pieces)) and all(n < sorted_keys[0] - 2900 for n in sorted_keys[1:-1])
    for bits in (20, 62):
        keys = np.array([pick.randrange(1 << bits) >> 3 << 3 for _ in range(50)] * 2, np.uint64)
        order, values = ordered(keys, bits)
        assert order.tolist() == np.argsort(keys, kind="stable").tolist() and values.tolist() == sorted(keys.tolist())


def test_runs_of_many_arrays():
    flags = [np.array(f, bool) for f in ([], [1], [0, 1, 1, 0, 1], [1, 1], [], [0, 0], [1, 0])]
    counts, begins, ends = repeats._runs(flags)
    assert counts.tolist() == [0, 1, 2, 1, 0, 0, 1]
    assert list(zip(begins.tolist(), ends.tolist())) == [(0, 1), (1, 3), (4, 5), (0, 2), (0, 1)]
    assert [x.tolist() for x in repeats._runs([])] == [[], [], []]


def test_rules(docs):
    got = rules.judge(clashing(docs, "n_words", "kept")).collect()
    assert len(got) == docs.count()
    for row in got:
        words = words_of(row.text)
        windows = [tuple(words[n : n + 8]) for n in range(len(words) - 7)]
        counts = Counter(windows)
        inside = {n + k for n, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
        lines = [line for line in (row.text or "").split("\n") if words_of(line)]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum(c in rules.SYMBOLS for c in row.text or "")
        assert row.n_dup_lines == len(lines) - len(set(lines)) and row.n_repeat_words == len(inside)
        assert row.base_failed == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        assert not (row.kept and row.base_failed)
    assert rules.keep_good(docs).columns == docs.columns


def test_rules_run_without_python(docs):
    plan = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def bag(text):
    words = words_of(text)
    return Counter(tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))) if words else Counter()


def true_classes(rows):
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    bags = [bag(r.text) for r in rows]
    for n in range(len(rows)):
        for m in range(n):
            less, more = (bags[n] & bags[m]).total(), (bags[n] | bags[m]).total()
            if more and 5 * less >= 4 * more:
                root[find(n)] = find(m)
    least = {}
    for n, r in enumerate(rows):
        least[find(n)] = min(least.get(find(n), r.doc_id), r.doc_id)
    return [(r.doc_id, least[find(n)] if bags[n] else r.doc_id) for n, r in enumerate(rows)]


def test_near_duplicates(docs):
    got = bagminhash.classify(clashing(docs, "class_id"))
    assert Counter((r.doc_id, r.class_id) for r in got.collect()) == Counter(true_classes(docs.collect()))
    first = bagminhash.keep_first(docs)
    assert first.columns == docs.columns
    assert sorted(r.doc_id for r in first.collect()) == sorted({c for _, c in true_classes(docs.collect())})


def test_one_document_of_each_class_whatever_the_ids(spark):
    texts = [" ".join(made_words(300 + n, 60)) for n in range(6)]
    near = texts[5].split()
    near[59] = "changed"
    rows = [(None, t) for t in texts[:3]] + [(None, texts[0]), (None, texts[4]), (3, texts[4]), (9, texts[4])]
    rows += [(5, texts[5]), (7, " ".join(near)), (7, texts[3]), (None, ""), (None, ""), (None, " "), (7, ""), (7, None)]
    docs = spark.createDataFrame([(k, t, "en", None, 0) for k, t in rows], DOCS)
    got = Counter((r.doc_id, r.text) for r in bagminhash.keep_first(docs).collect())
    want = [(None, t) for t in texts[:3]] + [(3, texts[4]), (5, texts[5]), (7, texts[3]), (None, ""), (None, " "), (7, ""), (7, None)]
    assert got == Counter(want)


@pytest.mark.parametrize("most", [1, 4])
def test_large_mixed_buckets(docs, monkeypatch, most):
    monkeypatch.setattr(bagminhash, "SMALL_BUCKET", most)
    got = bagminhash.classify(docs)
    assert Counter((r.doc_id, r.class_id) for r in got.collect()) == Counter(true_classes(docs.collect()))


def test_links_of_a_bucket_join_what_all_pairs_join():
    """Random bags in one bucket: kept links give the components of all pairs that are similar enough."""
    random = np.random.default_rng(5)
    bags_ = []
    for _ in range(12):
        base = random.integers(0, 10**9, 60)
        for _ in range(6):
            bag = base.copy()
            bag[random.permutation(60)[: random.integers(0, 8)]] = random.integers(0, 10**9)
            bags_.append(np.unique(bag))
    marks = np.zeros((len(bags_), bagminhash.REGISTERS), np.uint8)
    roots = [bytes([n // 2]) for n in range(len(bags_))]

    def classes(links):
        own = [n // 2 for n in range(len(bags_))]
        for a, b in links:
            own = [own[b] if x == own[a] else x for x in own]
        return {frozenset(n for n, x in enumerate(own) if x == one) for one in own}

    similar = {
        (a, b) for b in range(len(bags_)) for a in range(b)
        if 5 * len(np.intersect1d(bags_[a], bags_[b])) >= 4 * len(np.union1d(bags_[a], bags_[b]))
    }
    found = bagminhash.joining_pairs(roots, marks, bags_)
    assert set(found) <= similar and len(found) < len(similar)
    assert classes(found) == classes(similar)
    assert len(found) == 36 - len(classes(similar))


def test_signatures_estimate_weighted_similarity():
    pick = random.Random(3)
    pairs = []
    for _ in range(80):
        left = [pick.choice("abcdefgh") * pick.randrange(1, 4) for _ in range(150)]
        right = list(left)
        for _ in range(pick.randrange(12)):
            right[pick.randrange(150)] = "zz"
        many = pick.randrange(40)
        pairs.append((" ".join(left + ["x"] * many), " ".join(right + ["x"] * (many + pick.randrange(60)))))
    raws = [t.encode() for p in pairs for t in p]
    offsets = np.append(0, np.cumsum([len(r) for r in raws]))
    rows = bagminhash.signatures(*bagminhash.bags(np.frombuffer(b"".join(raws), np.uint8), offsets), len(raws))
    guess = (rows[0::2] == rows[1::2]).mean(axis=1)
    truth = np.array([(bag(a) & bag(b)).total() / (bag(a) | bag(b)).total() for a, b in pairs])
    assert abs((guess - truth).mean()) < 0.02


def test_components(spark):
    chain = [(n, n + 1) for n in range(0, 40)] + [(100, 101), (103, 102), (102, 100), (7, 7)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 104)}


@pytest.mark.parametrize("limit", [contamination.INDEX_BYTES, 400])
def test_contamination(spark, docs, limit):
    texts = [r.text for r in docs.collect()]
    items = [(0, " ".join(words_of(texts[20])[3:40])), (1, "One, TWO"), (2, None), (None, "one"), (3, ""), (4, texts[7].upper()), (4, texts[7]), (5, "ÉÉ x1")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    windows = defaultdict(set)
    for item, text in items:
        words = pattern.findall((text or "").translate(lower))
        for n in range(max(1, len(words) - 12)) if words else ():
            windows[tuple(words[n : n + 13])].update([] if item is None else [str(item)])
    got = contamination.find_contamination(clashing(docs, "n_hit", "items"), benchmark, limit=limit).collect()
    for row in got:
        words = pattern.findall((row.text or "").translate(lower))
        hit, found = set(), set()
        for window, owners in windows.items():
            for n in range(len(words) - len(window) + 1):
                if tuple(words[n : n + len(window)]) == window:
                    hit.update(range(n, n + len(window)))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (len(words), len(hit), len(found), digest)
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
    assert sum(r.contaminated for r in got) > 2
    assert contamination.drop_contaminated(docs, benchmark, limit=limit).columns == docs.columns


def test_encoding_is_that_of_the_library(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    pick = random.Random(4)
    parts = list("ab'sSTtredlvmLl  \n\t\r 12²Ⅷ,.!éñß漢字  \x85\x1c\x00😀-_'") + ["'re", "'ll", " '", "<|endoftext|>", "the ", "ing"]
    fuzz = spark.createDataFrame([(1000 + n, "".join(pick.choice(parts) for _ in range(pick.randrange(60))), None, None, 0) for n in range(800)], DOCS)
    table = docs.unionByName(fuzz)
    got = lexicon.round_trip_digests(clashing(table, "n_tokens").withColumn("whole", F.col("text")), VOCABULARY, words=300).collect()
    assert len(got) == table.count()
    for row in got:
        ids = tokenizer.encode(row.whole or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    decoded = lexicon.decode(lexicon.encode(table, VOCABULARY, words=50), VOCABULARY)
    assert Counter((r.doc_id, r.text) for r in decoded.collect()) == Counter((r.doc_id, r.text or "") for r in table.collect())


def test_long_words_merge_alike():
    vocabulary = lexicon.load_vocabulary(VOCABULARY)
    for word in (b"a" * 190, b"abcab" * 30, "éß漢".encode() * 9):
        data = np.frombuffer(word, np.uint8)
        ids, counts = lexicon.merge_many(data, np.array([0]), np.array([len(word)]), vocabulary)
        assert ids.tolist() == lexicon.merge_one(word, vocabulary) and counts.tolist() == [len(ids)]


def test_merged_words_lie_in_one_array():
    vocabulary = lexicon.load_vocabulary(VOCABULARY)
    small = lexicon.Encoder(vocabulary, remembered=150)
    for n in range(6):
        texts = [" ".join(made_words(k % 5, 40 + k)) for k in range(n, n + 4)]
        blob, offsets = lexicon.ragged_bytes([t.encode() for t in texts])
        got, want = small.encode(blob, offsets), lexicon.Encoder(vocabulary).encode(blob, offsets)
        assert all((a == b).all() for a, b in zip(got, want))
        # a word's number leads to its ids; no array a word
        assert sorted(small.known.values()) == list(range(len(small.id_offsets) - 1)) and small.id_offsets[-1] == len(small.ids)
        for word, number in small.known.items():
            assert small.ids[small.id_offsets[number] : small.id_offsets[number + 1]].tolist() == lexicon.merge_one(word, vocabulary)


def test_transducer_holds_exactly_its_words():
    vocabulary = lexicon.load_vocabulary(VOCABULARY)
    words = sorted({w.encode() for w in made_words(3, 400)})
    held = lexicon.compile_words(words[::2], vocabulary)
    blob, offsets = lexicon.ragged_bytes(words)
    assert held.numbers(blob, offsets[:-1], offsets[1:]).tolist() == [n // 2 if n % 2 == 0 else -1 for n in range(len(words))]


def test_packing_loses_nothing(docs):
    packed = packing.pack(docs, VOCABULARY, length=64, group=3000)
    tokens = Counter()
    for row in lexicon.encode(docs, VOCABULARY).collect():
        tokens.update([(row.doc_id, n, t) for n, t in enumerate(row.token_ids)])
    found = Counter()
    for row in packing.unpacked(packed).collect():
        found.update([(row.doc_id, row.first_token + n, t) for n, t in enumerate(row.token_ids)])
    assert found == tokens
    for row in packed.collect():
        assert len(row.input_ids) == len(row.position_ids) == 64 and row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] == row.n_tokens <= 64
        assert row.position_ids[: row.n_tokens] == [n for a, b in zip(row.cu_seqlens, row.cu_seqlens[1:]) for n in range(b - a)]


def test_best_fit_takes_the_tightest_row():
    pick = random.Random(2)
    sizes = np.array([pick.randrange(1, 50) for _ in range(300)])
    free: list[int] = []
    for size in sorted(sizes.tolist(), reverse=True):
        fits = [n for n, space in enumerate(free) if space >= size]
        if fits:
            free[min(fits, key=lambda n: free[n])] -= size
        else:
            free.append(49 - size)
    assert sorted(49 - sum(int(sizes[p]) for p in row) for row in packing.best_fit(sizes, 49)) == sorted(free)


def test_archives(spark, tmp_path):
    rows = [(n, f"http://x/{n}?a=ä b", f"<p>{'word ' * (n % 7) * 40}</p>") for n in range(120)]
    rows += [(500, None, "z" * 1500), (501, "u", "z" * 1500), (None, "u", "z" * 1500), (502, "u", None), (503, "u", ""), (501, "u", "z" * 1500)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "payload_bytes")
    got = warc.archived(pages, payloads=True).collect()
    last = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page is not None:
            last[raw] = max(last.get(raw, page), page)
    want = Counter()
    for page, url, html in rows:
        raw = (html or "").encode()
        refers = last[raw] if raw in last and last[raw] != page else None
        want[page, url, len(raw), hashlib.sha1(raw).hexdigest(), "response" if refers is None else "revisit", refers] += 1
    assert Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")


def test_broken_archives_are_refused():
    import zstandard

    record = warc.build_record(1, "u", b"hello", hashlib.sha1(b"hello").hexdigest(), 5, None)
    frame = zstandard.ZstdCompressor(write_checksum=True, write_content_size=True).compress
    assert [r["payload"] for r in warc.read_archive(frame(record) + b"P*M\x18\0\0\0\0")] == [b"hello"]
    for bad in (frame(record)[:-3], frame(record) + b"junk", frame(record.replace(b"hello", b"hallo")), frame(record[:-1]), b"P*M"):
        with pytest.raises((warc.BadArchive, zstandard.ZstdError)):
            list(warc.read_archive(bad))


def test_compact_windows_are_the_wide_nodes_of_the_tree():
    pick = random.Random(2)
    values, firsts = np.array([pick.randrange(50) for _ in range(300)], np.uint64), np.array([0, 120, 120, 130, 300])
    want = set()
    for a, b in zip(firsts, firsts[1:]):
        for c in range(a, b):
            left, right = c, c
            while left > a and values[left - 1] > values[c]:
                left -= 1
            while right + 1 < b and values[right + 1] >= values[c]:
                right += 1
            if right - left + 1 >= 8:
                want.add((left, c, right))
    assert set(zip(*[x.tolist() for x in passages.compact_windows(values, firsts, 8)])) == want


def test_passages(docs):
    rows = docs.collect()
    got = defaultdict(list)
    for row in passages.find(clashing(docs, "spans", "class_id"), keep_text=False).collect():
        got[row.doc_id].append(row)
    seen = defaultdict(list)
    for n, row in enumerate(rows):
        words = words_of(row.text)
        for at in range(len(words) - 49):
            seen[tuple(words[at : at + 50])].append((n, at))
    found = []
    for places in seen.values():
        if len({n for n, _ in places}) > 1:
            for n, at in places:
                found.append(any(s.begin <= at and at + 50 <= s.end for s in got[rows[n].doc_id][0].spans))
            assert len({got[rows[n].doc_id][0].class_id for n, _ in places}) == 1
    # a passage whose only equal is not the least window of its value may be missed
    assert len(found) > 500 and np.mean(found) > 0.95, np.mean(found)
    # as all windows of a value meet, none is missed
    assert all(found)
    alone = [r for r in rows if r.text and len(words_of(r.text)) == 6000]
    assert all(not got[r.doc_id][0].spans and got[r.doc_id][0].class_id == r.doc_id for r in alone)


def test_all_exact_repeats_amid_boilerplate(spark, monkeypatch):
    """Repeats whose first 40 words are boilerplate of other texts, so that no window of theirs is a least one."""
    common, texts, want = made_words(50, 40), [], []
    for n in range(60):
        tail = made_words(2000 + n, 10)
        for copy in range(2):
            front, back = made_words(3000 + 2 * n + copy, 60), made_words(4000 + 2 * n + copy, 60)
            texts.append(" ".join(front + common + tail + back))
            want.append((60, 110))
    texts += [" ".join(made_words(6000 + n, 60) + common + made_words(7000 + n, 70)) for n in range(40)]
    docs = spark.createDataFrame([(n, t, "en", None, 0) for n, t in enumerate(texts)], DOCS)
    for most in (2_000, 7):
        monkeypatch.setattr(passages, "PART_WINDOWS", most, raising=False)
        got = {r.doc_id: r for r in passages.find(docs).collect()}
        lost = [n for n, (x, y) in enumerate(want) if not any(s.begin <= x and y <= s.end for s in got[n].spans)]
        assert not lost and all(got[n].class_id == got[n ^ 1].class_id for n in range(len(want)))


def test_passages_near_the_bound(spark):
    """Pairs of 50 words, one of them changed: 41 of 51 shingles are common."""
    texts = []
    for n in range(1500):
        words = made_words(20_000 + n, 50)
        texts += [" ".join(words), " ".join([*words[:25], "changed", *words[26:]])]
    docs = spark.createDataFrame([(n, t, "en", None, 0) for n, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.n_repeated_words for r in passages.find(docs).collect()}
    # six functions that all differ are to be expected in 0.006 % of the pairs
    assert np.mean([got[n] != 50 for n in range(len(texts))]) < 0.001


def test_compared_windows_are_those_that_all_pairs_give():
    pick = np.random.default_rng(4)
    base = pick.integers(0, 10**9, 91)
    grams = []
    for n in range(30):
        one = np.where(np.arange(91) < 30 + 3 * (n % 20), base, pick.integers(0, 10**9, 91))
        one[pick.integers(0, 91, pick.integers(0, 4))] = n
        one[45] = base[45]
        grams.append(one[pick.integers(0, 20) : 91 - pick.integers(0, 20)])

    def passage(n, i):
        return set(grams[n][i : i + passages.SPAN].tolist())

    want, starts = set(), [len(g) - passages.SPAN + 1 for g in grams]
    for n in range(30):
        for m in range(n):
            for i in range(starts[m]):
                for j in range(starts[n]):
                    x, y = passage(m, i), passage(n, j)
                    if 5 * len(x & y) >= 4 * len(x | y):
                        want |= {(m, i), (n, j)}
    count = list(range(30))
    found = passages.compared(count, [0] * 30, count, [False] * 30, [0] * 30, grams, False)
    got = {p for m, n, points in found for i, j in zip(points[::2], points[1::2]) for p in ((m, i), (n, j))}
    assert len(want) > 50 and got == want


def test_windows_of_known_length_are_those_of_the_tree():
    pick = np.random.default_rng(3)
    values, firsts = pick.integers(0, 2**63, 400).astype(np.uint64), np.array([0, 150, 150, 160, 400])
    values[200:230] = values[170:200]
    low, c, high = passages.passage_windows(values, firsts)
    left, place, right = passages.compact_windows(values, firsts)
    assert c.tolist() == place.tolist()
    assert low.tolist() == np.maximum(left, place - passages.SPAN + 1).tolist() and high.tolist() == np.minimum(place, right - passages.SPAN + 1).tolist()


def test_passages_without_their_like_are_not_looked_into_pair_by_pair(monkeypatch):
    """Windows with an edit each, of other length in each, share most shingles but no similar passage."""
    pick = np.random.default_rng(9)
    base = pick.integers(0, 10**9, 86)
    grams = [np.r_[base[:40], 10**9 + 100 * n + np.arange(5), base[40 + n % 2 :]][: 2 * passages.SPAN - 1] for n in range(40)]
    open_ = np.arange(passages.SPAN) == 25
    calls = []
    alike = passages.alike
    monkeypatch.setattr(passages, "alike", lambda *sides: calls.append(1) or alike(*sides))
    count = list(range(40))
    known = [~open_[: len(g) - passages.SPAN + 1] for g in grams]
    pairs = passages.compared(count, [0] * 40, [0] * 40, known, [0] * 40, grams, False)
    # 780 pairs of windows; each passage is met by its like at once
    assert len(calls) <= 40 and {x for p in pairs for x in p[:2]} == set(count)


def test_passages_alike_in_one_alignment_are_found_without_a_look_at_each_pair(monkeypatch):
    """Windows with five shingles of their own, each at another place, are like one without any."""
    pick = np.random.default_rng(11)
    base = pick.integers(0, 10**9, passages.SPAN)
    grams = [base, *(np.r_[base[:n], 10**9 + 100 * n + np.arange(5), base[n + 5 :]] for n in range(passages.SPAN - 5))]
    count, calls = list(range(len(grams))), []
    alike = passages.alike
    monkeypatch.setattr(passages, "alike", lambda *sides: calls.append(1) or alike(*sides))
    pairs = passages.compared(count, [0] * len(grams), count, [False] * len(grams), [0] * len(grams), grams, False)
    assert {x for p in pairs for x in p[:2]} == set(count) and not calls


def test_language_and_quality(spark):
    pick = random.Random(8)
    lists = {"en": "the of and this house water with that over".split(), "fr": "le les des maison eau avec être où été".split()}
    texts = [(n, " ".join(pick.choice(lists[lang]) for _ in range(pick.randrange(5, 120))), lang, None, 0) for n in range(400) for lang in [("en", "fr")[n % 2]]]
    texts += [(1000, None, "en", None, 0), (1001, "", "fr", None, 0), (1002, "123 !!", "en", None, 0), (1003, "the house", None, None, 0), (None, "the water", "en", None, 0)]
    docs = spark.createDataFrame(texts, DOCS)
    got = language.predict(clashing(docs, "score"), language.fit(docs)).withColumn("held", sampling.held_out()).collect()
    held = [r for r in got if r.held and r.doc_id is not None and r.doc_id < 1000]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == dict.fromkeys((1000, 1001, 1002), "und")
    none = language.predict(docs, language.fit(docs.where("lang is null")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}

    labels = spark.createDataFrame([(n, int(n % 4 > 0)) for n in range(400)] + [(1, None), (2, 1), (None, 0)], "doc_id long, quality int")
    marked = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" $$$ ### $$$ ###"))).otherwise(F.col("text")))
    scored = quality.score(clashing(marked, "predicted"), quality.fit(marked, labels)).withColumn("held", sampling.held_out()).collect()
    right = [r.predicted == int(r.doc_id % 4 > 0) for r in scored if r.held and r.doc_id is not None and r.doc_id < 1000]
    assert np.mean(right) > 0.95 and len(scored) == docs.count()
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_empty_tables(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    results = [
        language.predict(empty, language.fit(empty)),
        repeats.remove_repeats(empty),
        rules.judge(empty),
        quality.score(empty, quality.fit(empty, labels)),
        passages.find(empty),
        bagminhash.classify(empty),
        lexicon.round_trip_digests(empty, VOCABULARY),
        contamination.find_contamination(empty, benchmark),
        warc.archived(pages),
        packing.pack(empty, VOCABULARY),
    ]
    assert [r.count() for r in results] == [0] * 10


def test_pipeline_stages(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    words = words_of(docs.where("doc_id = 30").first().text)
    spark.createDataFrame([(0, " ".join(words[:20]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    before = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "repeated strings", "benchmark decontamination", "encoding and decoding"]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, folder)
        if n < 4:
            assert after.columns == docs.columns
        after.write.parquet(f"{folder}/stage{n}")
        after = spark.read.parquet(f"{folder}/stage{n}")
        assert after.count() <= before.count()
        before = after
    want = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in before.collect())
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, folder).collect()) == want
