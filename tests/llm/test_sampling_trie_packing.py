"""Prefix trie, importance resampling and packing against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hospiq.llm import packing, prefix_trie, resample
from hospiq.llm.common import numbered, segments

from .conftest import prose

TURNS = "conv_id long, turn long, role string, text string, path string, skeleton int"


def brute_trie(rows, rebuild=True):
    """Nodes as {(depth, turns): ...} from (conv_id, turn, role, text) rows."""
    conv = defaultdict(list)
    for c, t, role, text in rows:
        turn = (role or "", text or "")
        key = hashlib.sha256(f"{len(turn[0])}:{turn[0]}{turn[1]}".encode()).digest()[:16]
        conv[c].append(((t is not None, t or 0), key, turn))
    own = {c: [x[2] for x in sorted(v)] for c, v in conv.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild and c is not None else 0
        paths[c] = tuple((own.get(c - c % 100, []) if c is not None else [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    low = {p: min(m, key=lambda c: (c is None, c)) for p, m in members.items()}
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted((c for c in m if len(paths[c]) == len(p)), key=lambda c: (c is None, c))
        out.append((low[p], len(p), low[p[:-1]] if p else None, len(m), children[p], sum(1 for q in below if not children[q]),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join("null" if c is None else str(c) for c in ends).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(rng, n):
    first = [("user", prose(rng, 4)) for _ in range(3)]
    rows = []
    for c in range(n):
        turns = [first[0] if rng.random() < 0.5 else rng.choice(first)]
        while rng.random() < 0.75:
            turns.append((rng.choice(["assistant", "user", None]), rng.choice(["a", "b", "", None, "é🙂", "hello"])))
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    same = [("user", "x"), ("assistant", "yy"), ("user", "z")]
    rows += [(c, k, r, t) for c in range(n, n + 300) for k, (r, t) in enumerate(same)]
    rows += [(5000, k, "user", "long") for k in range(200)] + [(5001, k, "user", "long") for k in range(190)]
    rows += [(7000, None, "user", "null turn"), (7000, 3, "user", "b"), (7000, 3, "user", "a"), (None, 0, None, None), (None, 1, "q", "r")]
    return rows


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_prefix_trie(spark, shards):
    rows = conversations(random.Random(3), 260)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], TURNS).repartition(4)
    paths = prefix_trie.rebuilt_paths(df)
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(paths, shards).collect()), key=str)
    assert got == brute_trie(rows)


def test_prefix_trie_of_whole_conversations_shallow_splitters(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 7)
    rows = conversations(random.Random(9), 80)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], TURNS)
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.conversation_paths(df), 9).collect()), key=str)
    assert got == brute_trie(rows, rebuild=False)
    paths = prefix_trie.member_paths(prefix_trie.conversation_paths(df))
    borders = prefix_trie.splitters(paths, 9, depth=2)
    assert borders and all(len(b) <= 2 * prefix_trie.TOKEN for b in borders)
    assert len(prefix_trie.Skeleton(borders).parent) <= 1 + 2 * len(borders)


def test_prefix_trie_of_an_empty_table_and_of_turnless_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt_paths(empty)).collect() == []
    turnless = spark.createDataFrame([(3, b""), (1, b"")], "conv_id long, path binary")
    got = prefix_trie.prefix_trie(turnless, 3).collect()
    assert [tuple(r) for r in got] == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,3").hexdigest())]


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text, n_buckets, max_n):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    f = [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(x.encode()) % n_buckets for x in f]


def brute_resample(docs, target, n_buckets, max_n, percent, min_words):
    feats = [(i, *brute_features(t, n_buckets, max_n)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in feats:
        s.update(f)
    for x in target:
        t.update(brute_features(x, n_buckets, max_n)[1])
    ss, tt, b = sum(s.values()), sum(t.values()), n_buckets
    out = []
    for i, n_words, f in feats:
        gain = [math.floor(1000 * math.log((t[k] + 1) * (ss + b) / ((s[k] + 1) * (tt + b)))) for k in f]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = Counter()
    ranks = defaultdict(list)
    for k, r in enumerate(eligible[:len(eligible) * percent // 100]):
        ranks[r].append(k + 1)
    rows = []
    for r in out:
        rows.append((*r, ranks[r][rank[r]] if rank[r] < len(ranks[r]) else None))
        rank[r] += 1
    return sorted(rows, key=str)


@pytest.mark.parametrize("max_n,buckets", [(1, 10_000), (3, 50)])
def test_resample(spark, corpus, max_n, buckets):
    rows, df, item = corpus
    more = [(None, prose(random.Random(5), 30), None, None, ""), (None, None, None, None, ""), (4, rows[4][1], None, None, ""),
            (4, rows[4][1], None, None, ""), (900, "A-b 9\x00é" * 9 + "\x7f{Zz}", None, None, "")]
    df = df.unionByName(spark.createDataFrame(more, df.schema))
    target = [item, None, "", rows[7][1], item]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resample.resample(df, bench, percent=30, max_n=max_n, n_buckets=buckets).collect()
    want = brute_resample([r[:2] for r in [*rows, *more]], target, buckets, max_n, 30, 20)
    assert sorted((tuple(r) for r in got), key=str) == want
    again = resample.resample(df.repartition(7), bench, percent=30, max_n=max_n, n_buckets=buckets).collect()
    assert sorted((tuple(r) for r in again), key=str) == want


def test_resample_empty_tables(spark, corpus):
    rows, df, _ = corpus
    none = spark.createDataFrame([], "item_id long, text string")
    got = resample.resample(df, none).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_resample([r[:2] for r in rows], [], 10_000, 1, 10, 20)
    assert resample.resample(df.limit(0), none).collect() == []


def test_long_text_goes_by_in_pieces():
    text = prose(random.Random(2), 3000)
    assert "".join(segments(text, 50)) == text and len(list(segments(text, 50))) > 100
    assert list(segments("x" * 300 + " y", 50)) == ["x" * 300 + " ", "y"]
    whole = resample.text_histogram(text, 3, 997)
    resample_segments, resample.segments = resample.segments, lambda t: segments(t, 64)
    try:
        parts = resample.text_histogram(text, 3, 997)
    finally:
        resample.segments = resample_segments
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))


def test_numbered(spark):
    df = spark.range(0, 3000, numPartitions=6).selectExpr("(id * 7919) % 1000 AS k", "id")
    got = [(r.k, r.id) for r in numbered(df, [df.k.desc(), df.id.asc()], "place").orderBy("place").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1]))
    assert [r.place for r in numbered(df, [df.k, df.id], "place").orderBy("place").collect()] == list(range(3000))


HARD = ["Don't stop!! it's 3.14, ok?", "<|endoftext|> in <|startoftext|>text", "İstanbul İ, x", "Σίσυφος ΣΑΣ, ΑΣ.", "áé. ́x",
        "a≮b x≠y", "tab\tand\r\nlines\n\n  end  ", "...?! a.b.c,d", "ﬁ ǅ ½ Ⅷ x², y", "漢字 かな, 한국어. 🙂🙂 !", "\x00\x1c\x85\xa0　z", "z" * 500 + ", " + "é" * 300,
        "l'été's we'll ,x .y ;", "word." * 50, "Ab,", "Ab", ",", "Å, ñ."]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def test_encoder_gives_the_librarys_ids(corpus, tokenizer):
    enc = packing.Encoder(packing.default_tokenizer())
    texts = [r[1] or "" for r in corpus[0]] + HARD
    rng = random.Random(6)
    alphabet = "aB é́.,!'?<=≯\n\t3İΣ漢-|"
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        assert b"".join(enc.ids(t)) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def as_block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw])


def test_encoder_shows_letters_to_the_library_once(tokenizer, monkeypatch):
    enc = packing.Encoder(packing.default_tokenizer())
    seen, tok = [], enc.tok

    class Watched:
        def encode_batch_fast(self, texts, **how):
            seen.extend(w for t in texts for w in t.split(" "))
            return tok.encode_batch_fast(texts, **how)
        encode = None
    enc.tok = Watched()
    texts = ["Haanth (haanth) HAANTH!! haanth,\nhaanth", "", "haanth?! \u00c9t\u00e9", "HAANTH \u00c9T\u00c9!!", ""]
    monkeypatch.setattr(packing, "MEMO", 3)         # what is remembered is thinned out between the blocks
    for part in (texts, texts[:1], ["", ""], [], texts):
        got = enc.block(*as_block(part))
        assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]
        if part is texts and len(seen) < 12:
            assert sorted(seen) == sorted(["haanth", "\u00e9t\u00e9", "(", ")", "!!", ",", "?!"])


def one_by_one(histogram, capacity):
    """Best two fit, a sequence at a time."""
    left, out = Counter(histogram), []
    while +left:
        chosen, gap = [], capacity
        while fits := [k for k, n in left.items() if n > 0 and k <= gap]:
            k = max(fits)
            left[k] -= 1
            chosen.append(k)
            gap -= k
        if len(chosen) > 1 and gap:
            room, best = gap + chosen[-1], (chosen[-1],)
            some = sorted(k for k, n in left.items() if n > 0 and k <= room)
            for a in some:
                for b in some:
                    if b >= a and a + b <= room and a + b > best[0] and (a != b or left[a] > 1):
                        best = (a + b, a, b)
            if len(best) > 1:
                left[chosen.pop()] += 1
                left.subtract(best[1:])
                chosen += best[1:]
        out.append(sorted(chosen, reverse=True))
    return sorted(out)


def test_plan_equals_filling_one_by_one():
    rng = random.Random(1)
    for _ in range(150):
        capacity, h = rng.choice([10, 30, 64, 100]), Counter()
        for _ in range(rng.randint(1, 100)):
            h[rng.randint(1, capacity)] += rng.choice([1, 1, 2, 9])
        got = sorted(sorted(p, reverse=True) for p, n in packing.plan(h, capacity) for _ in range(n))
        assert got == one_by_one(h, capacity)
    assert packing.plan({}, 10) == []


@pytest.mark.parametrize("capacity", [4096, 50])
def test_packing(spark, corpus, tokenizer, capacity):
    rows, df, _ = corpus
    more = [(None, "no id", None, None, ""), (4, rows[4][1], None, None, ""), (4, rows[4][1], None, None, ""), (950, "", None, None, "")]
    df = df.unionByName(spark.createDataFrame(more, df.schema))
    packed = packing.pack(df, capacity=capacity, with_ids=True).cache()
    got = packed.collect()
    want, lengths = Counter(), Counter()
    for i, t in [r[:2] for r in [*rows, *more]]:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            lengths[len(part)] += 1
            want[i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length, r.ids))
    for parts in by.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:k]) for k in range(len(parts))]
        assert parts[-1][0] + parts[-1][1] <= capacity
    assert sorted(by) == list(range(len(one_by_one(lengths, capacity))))
    for s in packing.sequences(packed).collect():
        assert b"".join(p[2] for p in by[s.sequence_id]) == np.array(s.ids, "<u4").tobytes()
        assert list(s.starts) == [p[0] for p in by[s.sequence_id]]
    assert packing.pack(df.limit(0)).collect() == []


def test_piece_borders():
    def lengths(n, capacity):
        return [len(p) // 4 for p in packing.cut([b"\0\0\0\0" * n], 1, capacity)]
    assert lengths(0, 5) == [1] and lengths(4, 5) == [5] and lengths(5, 5) == [5, 1] and lengths(10, 5) == [5, 5, 1]
