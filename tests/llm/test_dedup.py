"""Exact dedup, near dedup, long repeats and decontamination against brute force."""
import random

import pytest

from hospiq.llm import decontam, exact_dedup, near_dedup, suffix_dedup

from . import brute
from .conftest import edited, prose

SCHEMA = "doc_id long, text string, lang string, source string, kept string"


def test_exact_dedup(spark, corpus):
    rows, df, _ = corpus
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == brute.exact([r[:2] for r in rows])


def test_exact_dedup_empty_table_repeated_rows_and_null_id(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(empty).collect() == []
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab"), (None, "a  b"), (None, "q")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect())
    assert got == [(False, 1, None, 3, False), (False, 2, None, 3, False), (True, None, None, 1, True), (True, None, None, 3, True)]
    kept = exact_dedup.drop_exact_copies(spark, df).collect()
    assert sorted(r.text for r in kept) == ["a  b", "q"]


def test_exact_dedup_weak_identifier_collision(spark):
    """Equal weak identifiers of different chunks fall back on the strong ones."""
    rec = spark.createDataFrame([(1, 5, "x", [b"w"], [b"s1"]), (2, 5, "y", [b"w"], [b"s2"]), (3, 5, "z", [b"v"], [b"s3"])],
                                exact_dedup.RECIPE)
    got = {r.id: r.ids for r in exact_dedup.verified_recipes(rec).collect()}
    assert got == {1: [b"s1"], 2: [b"s2"], 3: [b"v"]}


def test_chunk_borders_depend_on_the_text_only():
    import numpy as np
    rng = random.Random(1)
    a, b = prose(rng, 3000).replace(" ", "").encode(), prose(rng, 3000).replace(" ", "").encode()
    alone = list(exact_dedup._block(np.frombuffer(a, np.uint8), np.array([0, len(a)])))[0]
    both = list(exact_dedup._block(np.frombuffer(b + a, np.uint8), np.array([0, len(b), len(a) + len(b)])))[1]
    assert alone == both and len(alone[2]) > 3


def test_near_dedup(spark, corpus):
    rows, df, _ = corpus
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(df).collect()}
    assert got == brute.near([r[:2] for r in rows])


def test_near_dedup_chains_hot_buckets_and_hubs(spark, monkeypatch):
    """A chain of edits links far ends; tiny limits split buckets and hubs."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "SALT", 2)
    rng = random.Random(8)
    t = prose(rng, 120)
    rows = []
    for i in range(30):
        rows.append((100 - i, t))
        t = edited(rng, t, 3)
    rows += [(200 + i, edited(rng, rows[0][1], 12)) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(df).collect()}
    assert got == brute.near(rows)


def test_near_dedup_writes_links_not_pairs(spark, monkeypatch):
    """Many documents that share most of a text, few of them similar enough:
    what leaves the blocks stays below the number of members."""
    rng = random.Random(21)
    base = prose(rng, 40)
    rows = [(i, edited(rng, base, rng.randint(3, 7))) for i in range(300)]
    made = []
    real = near_dedup.cross_links

    def counted(buckets, *more):
        out = real(buckets, *more)
        made.append((buckets.count(), out.count()))
        return out
    monkeypatch.setattr(near_dedup, "cross_links", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(df).collect()}
    assert got == brute.near(rows)
    assert made and all(links < members for members, links in made)


def test_prefixes_share_a_shingle_where_sets_are_similar():
    import numpy as np
    rng = random.Random(2)
    for _ in range(200):
        base = rng.sample(range(400), rng.randint(1, 60))
        sets = [np.unique(np.array(base + rng.sample(range(400), rng.randint(0, 12)), np.uint64)) for _ in range(6)]
        flat, o = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        token, owner = near_dedup.prefix_lists(flat, o, 80)
        have = [set(token[owner == k].tolist()) for k in range(6)]
        for a in range(6):
            alike = near_dedup.alike(sets[a], flat, o[:-1], o[1:], 80)
            for b in range(6):
                both = len(np.intersect1d(sets[a], sets[b]))
                want = 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
                assert alike[b] == want and (not want or have[a] & have[b])


def test_long_words_of_a_regular_pattern_differ(spark):
    """Thue-Morse words and their complements have equal polynomial hashes."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, other = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    df = spark.createDataFrame([(1, one), (2, other), (3, one.upper())], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(df).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_near_dedup_repeated_rows(spark):
    rng = random.Random(5)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a)] * 40 + [(2, edited(rng, a, 2))] * 40 + [(3, b), (4, edited(rng, b, 1)), (None, edited(rng, b, 1))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id) for r in near_dedup.near_dedup(df).collect())
    assert got == [(0, 3), (1, 1), (2, 1), (3, 3), (4, 3)]


def test_near_dedup_empty_table_null_and_shared_ids(spark):
    assert near_dedup.near_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    rng = random.Random(3)
    a, b = prose(rng, 50), prose(rng, 50)
    df = spark.createDataFrame([(5, a), (5, b), (3, a), (9, b), (9, b), (None, "none like it")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_dedup(df).collect()}
    assert got == {(3, 3, True), (5, 3, False), (9, 3, False), (None, None, True)}


def test_near_dedup_rows_without_an_id_are_documents_of_their_own(spark):
    rng = random.Random(31)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(7, a), (9, b), (None, edited(rng, a, 1)), (None, edited(rng, b, 1)), (None, c), (None, edited(rng, c, 1)), (None, d),
            (3, prose(rng, 60)), (5, d + " x"), (None, None), (11, ""), (11, a + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_dedup(df).collect())
    assert got == sorted([(7, 7, True), (9, 9, True), (0, 7, False), (0, 9, False), (0, 0, True), (0, 0, False), (0, 5, False),
                          (3, 3, True), (5, 5, True), (0, 0, True), (11, 7, False), (11, 7, False)])
    kept = near_dedup.drop_near_copies(spark, df).collect()
    left = [r.text for r in kept if r.doc_id is None]
    assert len(left) == 2 and None in left and set(left) & {c, rows[5][1]}
    assert {(r.doc_id, r.text) for r in kept if r.doc_id} == {(7, a), (9, b), rows[7], (5, d + " x"), (11, "")}


def test_near_copies_stage_links_texts_of_a_repeated_id_separately(spark):
    rng = random.Random(32)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(3, a), (5, edited(rng, a, 1)), (5, b), (9, edited(rng, b, 1)), (5, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_dedup.drop_near_copies(spark, df).collect()} == {(3, a), (5, b), (5, c)}


@pytest.mark.parametrize("hot", [50_000, 1])
def test_long_repeats(spark, corpus, hot):
    rows, df, _ = corpus
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df, length=60, gram=16, hot=hot).collect()}
    assert got == dict(zip([r[0] for r in rows], brute.repeats([r[1] for r in rows], 60), strict=True))
    full = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()}
    assert full == dict(zip([r[0] for r in rows], brute.repeats([r[1] for r in rows], 400), strict=True))


def test_long_repeats_empty_table_and_repeated_rows(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    text = prose(random.Random(2), 200)
    df = spark.createDataFrame([(1, text), (1, text), (None, "short")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df).collect())
    assert got == [(False, len(text.encode()), 1), (False, len(text.encode()), 1), (True, 0, 0)]


def test_huge_text_is_cut_into_overlapping_steps(monkeypatch):
    import numpy as np
    text = np.frombuffer(prose(random.Random(6), 4000).encode(), np.uint8)
    whole = suffix_dedup.sampled(text, np.array([0, len(text)]), 100, 16)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    parts = suffix_dedup.sampled(text, np.array([0, len(text)]), 100, 16)

    def windows(e):
        return {int(lo) + k for lo, w in zip(e[1], e[2], strict=True) for k in range(int(w))}
    assert windows(whole) == windows(parts) == set(range(len(text) - 99))
    assert len(parts[0]) > len(whole[0])


def test_level_family_keeps_a_logarithmic_number_of_levels(spark, corpus):
    rows, df, _ = corpus
    src = df.selectExpr("doc_id AS id", "xxhash64(doc_id, text) AS rk", "coalesce(text, '') AS text")
    found = suffix_dedup.entries(src, 60, 16).cache()
    family = suffix_dedup.LevelFamily()
    for k in range(5):
        family.add(found.filter(f"pmod(id, 5) = {k}"))
    assert [x is not None for x in family.levels] == [True, False, True]
    got = {(r.key, r.cid): r.n for r in family.repeated().collect()}
    want = {}
    for r in found.collect():
        want[r.key, r.cid] = want.get((r.key, r.cid), 0) + 1
    keys = {}
    for (k, _), n in want.items():
        keys[k] = keys.get(k, 0) + n
    assert got == {kc: n for kc, n in want.items() if keys[kc[0]] > 1}


def test_decontamination(spark, corpus):
    rows, df, item = corpus
    rng = random.Random(12)
    long_item = prose(rng, 60)
    items = [(1, item), (2, long_item), (3, prose(rng, 20)), (4, None), (5, ""), (6, "Solo"), (7, edited(rng, rows[0][1] or "a b", 1))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    more = [(1000, edited(rng, long_item, 1), None, None, ""), (1001, edited(rng, long_item, 6), None, None, ""),
            (1002, prose(rng, 30) + " " + " ".join(long_item.split(" ")[2:]), None, None, "")]
    df = df.unionByName(spark.createDataFrame(more, SCHEMA))
    got = {r.doc_id: set(r["items"]) for r in decontam.find_leaks(df, bench, ["doc_id"]).collect()}
    want = {r[0]: brute.leaks(r[1], items) for r in [*rows, *more]}
    assert got == want and any(want.values())
    clean = decontam.drop_leaks(spark, df, bench)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {k for k, v in want.items() if not v}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.drop_leaks(spark, df, none).count() == df.count()
    assert decontam.find_leaks(spark.createDataFrame([], SCHEMA), bench, ["doc_id"]).collect() == []


def test_benchmark_in_blocks(spark, corpus, monkeypatch):
    rows, df, item = corpus
    monkeypatch.setattr(decontam, "ITEM_CHARS", 100)
    items = [(1, item), (2, prose(random.Random(5), 25)), (3, "solo")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontam.item_blocks(bench))) > 1
    got = {r.doc_id: set(r["items"]) for r in decontam.find_leaks(df, bench, ["doc_id"]).collect()}
    assert got == {r[0]: brute.leaks(r[1], items) for r in rows}


def test_decontamination_with_repeated_words_and_null_ids(spark):
    """One shingle that counts many times on one side, items without an id."""
    rng = random.Random(33)
    items, docs = [], []
    for k, (n, run) in enumerate([(40, 6), (60, 12), (90, 22), (150, 36)]):
        base, word = prose(rng, n), "zz"
        heavy = base + " " + " ".join([word] * (run + 4))
        items.append((k, heavy))
        for drop in range(0, run, 3):
            cut = base + " " + " ".join([word] * (run + 4 - drop))
            docs.append(prose(rng, 30) + " " + cut + " " + prose(rng, 30))
            docs.append(cut)
        items.append((100 + k, base))
        docs.append(prose(rng, 10) + " " + base + " " + " ".join([word] * run))
    items += [(None, prose(rng, 25)), (None, prose(rng, 25))]
    docs += [prose(rng, 9) + " " + items[-1][1] + " " + prose(rng, 9), prose(rng, 80), "zz " * 300]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: set(r["items"]) for r in decontam.find_leaks(df, bench, ["doc_id"]).collect()}
    want = {k: brute.leaks(t, items) for k, t in enumerate(docs)}
    assert got == want and any(None in v for v in want.values()) and sum(map(bool, want.values())) > 10
    assert {r.doc_id for r in decontam.drop_leaks(spark, df, bench).collect()} == {k for k, v in want.items() if not v}


CLASH = ["_sha", "_rn", "__items", "__best", "__keep_id", "__keep_key", "__t", "__text", "kept_id", "kept_raw", "kept_place", "keep_id", "keep_key",
         "leak_items", "leak_similarity", "found", "found_best", "searched", "map_text", "stage_lang", "stage_score", "sample_rank", "id", "key", "n", "items"]


@pytest.mark.parametrize("stage", ["language", "exact", "near", "leaks"])
def test_stages_leave_columns_of_any_name_alone(spark, corpus, stage):
    from hospiq.llm import langid
    rows, df, item = corpus
    from pyspark.sql import functions as F
    wide = df.filter("doc_id < 60").select("doc_id", "text", "lang", "source", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASH])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {"language": lambda: langid.keep_identified(spark, wide), "exact": lambda: exact_dedup.drop_exact_copies(spark, wide),
           "near": lambda: near_dedup.drop_near_copies(spark, wide), "leaks": lambda: decontam.drop_leaks(spark, wide, bench)}[stage]()
    assert out.columns == wide.columns
    got = out.collect()
    assert got and all(r[c] == f"{c}{r.doc_id}" for r in got for c in CLASH)


def test_exact_stage_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "a  b"), (2, "ab"), (3, None), (3, ""), (3, None), (None, "q"), (None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "") for r in exact_dedup.drop_exact_copies(spark, df).collect())
    assert got == [(0, "q"), (1, "a  b"), (3, "")]


def test_suffix_index_in_batches_equals_one_run(spark, corpus, tmp_path):
    """Every batch is added by an index object of its own, as by another session."""
    rows, df, _ = corpus
    base = f"{tmp_path}/suffixes"
    assert suffix_dedup.SuffixIndex(spark, base, 60, 16).remove_repeats() is None
    parts = [df.filter(f"coalesce(pmod(doc_id, 4), 0) = {k}") for k in range(4)] + [df.limit(0)]
    for k in range(3):
        assert suffix_dedup.SuffixIndex(spark, base, 60, 16).add(parts[k], f"part {k}")
        assert not suffix_dedup.SuffixIndex(spark, base, 60, 16).add(parts[k], f"part {k}")     # a batch counts once
    files = {p for p in (tmp_path / "suffixes" / "level").rglob("*.parquet")}
    index = suffix_dedup.SuffixIndex(spark, base, 60, 16)
    levels = index._family(index._listed()).levels
    assert [x is not None for x in levels] == [True, True]
    for k in (3, 4):
        assert suffix_dedup.SuffixIndex(spark, base, 60, 16).add(parts[k], f"part {k}")
    assert files <= {p for p in (tmp_path / "suffixes" / "level").rglob("*.parquet")}          # what is written stays
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.SuffixIndex(spark, base, 60, 16).remove_repeats().collect()}
    assert got == dict(zip([r[0] for r in rows], brute.repeats([r[1] for r in rows], 60), strict=True))
    with pytest.raises(ValueError):
        suffix_dedup.SuffixIndex(spark, base, 80, 16).add(parts[0], "other")


def test_suffix_index_two_writers_at_once(spark, tmp_path):
    from hospiq.operators.state import CommitConflict
    text = prose(random.Random(3), 300)
    first, second = (spark.createDataFrame([(k, text)], "doc_id long, text string") for k in (1, 2))
    base = f"{tmp_path}/suffixes"
    slow = suffix_dedup.SuffixIndex(spark, base, 60, 16)
    real = slow._family

    def family(rows, write):
        suffix_dedup.SuffixIndex(spark, base, 60, 16).add(first, "first")      # another session comes between
        return real(rows, write)
    slow._family = family
    with pytest.raises(CommitConflict):
        slow.add(second, "second")
    slow._family = real
    assert slow.add(second, "second")
    assert {(r.doc_id, r.n_removed) for r in slow.remove_repeats().collect()} == {(1, len(text.encode())), (2, len(text.encode()))}
