"""Operators over the corpus: near duplicates, repeats, lines, benchmark items, vectors, classifiers."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import EDGES, documents, groups_of, jaccard_groups, repeats, words_of
from pyspark.sql import functions as F

from tidemark.llm import ann, common, decontam, jaccard, linededup, quality, suffix, toxicity
from tidemark.llm.graph import components
from tidemark.llm.queries import ORACLES, QUERIES


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    links = [(a, b) for a, b in links if a != b]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == groups_of({x for e in links for x in e}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _near_duplicates(seed, voc):
    rnd = random.Random(seed)
    rows, n = [], 0
    for size in (3, 6, 20, 60, 150, 400):
        base = [f"w{rnd.randrange(voc)}" for _ in range(size)]
        for _ in range(rnd.choice([2, 30])):
            w = list(base)
            for _ in range(rnd.randint(0, 4)):
                k = rnd.randrange(len(w))
                w[k : k + 1] = rnd.choice([[w[k] + f"x{n}"], [w[k] + "y"], [], [w[k], "ins"]]) or (["z"] if len(w) == 1 else [])
            rows.append((n, " ".join(w)))
            n += 1
    return rows


@pytest.mark.parametrize("seed,voc,settings", [(0, 4000, jaccard.Settings()), (1, 40, jaccard.Settings(rounds=1, most_matches=3))])
def test_jaccard_like_brute_force(spark, seed, voc, settings):
    rows = _near_duplicates(seed, voc) + [(900, ""), (901, None), (902, "A b"), (903, "a B")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(documents(spark, rows), settings).collect()}
    assert got == jaccard_groups(rows)


def test_jaccard_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op8_ngram_jaccard"](spark, sf).collect()}
    assert got == jaccard_groups(rows)


def test_jaccard_edges(spark):
    got = jaccard.jaccard_groups(documents(spark, EDGES)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        [("1", 0, "1"), ("2", 0, "2"), ("3", 0, "3"), ("4", 1, "4"), ("5", 5, "5"), ("5", 5, "5"), ("None", 1, "None"), ("6", 1, "6")])
    assert jaccard.jaccard_groups(documents(spark, [])).count() == 0
    left = jaccard.one_of_each(documents(spark, [*EDGES, (7, "a b c d e f g h")]))
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "3", "4", "5", "6", "None"]


def _repeating(seed):
    rnd = random.Random(seed)
    passage = words_of(rnd, 60)
    texts = [words_of(rnd, rnd.choice([5, 60, 200])) for _ in range(20)]
    texts += [words_of(rnd, 40) + passage + words_of(rnd, 30) for _ in range(8)] + [texts[2]] * 3 + ["ab" * 400, "x" * 900, passage[:199], passage[:201], "", None]
    for _ in range(6):
        w = texts[3].split()
        w[rnd.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("settings", [suffix.Settings(), suffix.Settings(heavy=3), suffix.Settings(block=700, shard=5, held=20, small=0)])
def test_suffix_like_brute_force(spark, settings):
    texts = _repeating(4)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(documents(spark, rows), settings).collect()}
    assert [got[i] for i, _ in rows] == repeats(texts)


def test_suffix_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_suffix_dedup"](spark, sf).collect()}
    assert [got[r.doc_id] for r in rows] == repeats([r.text for r in rows])


def test_suffix_edges(spark):
    got = suffix.remove_repeats(documents(spark, EDGES), with_bytes=True).collect()
    want = Counter(zip((str(i) for i, _ in EDGES), repeats([t for _, t in EDGES])))
    assert Counter((str(r.doc_id), (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == want
    assert suffix.remove_repeats(documents(spark, [])).count() == 0


def test_transforms_merge_like_one_sort():
    rng = np.random.default_rng(5)
    for letters in (2, 5, 300):
        x = rng.integers(0, letters, (500, 3)).astype(np.uint64) << np.uint64(40)
        whole, merged = suffix.build(np.arange(500), x), suffix.merge_all(x, 37)
        assert (whole.letters == merged.letters).all() and (whole.common == merged.common).all()


def _lines_left(texts, least=5):
    """Normalised lines of ``least`` words or more, of all texts together."""
    split = lambda s: tuple(w for w in re.split(r"[\s!-/:-@\[-`{-~]+", s.lower()) if w)
    return Counter(w for t in texts for line in (t or "").split("\n") if len(w := split(line)) >= least)


def test_line_dedup_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r.doc_id: r for r in linededup.dedup_lines(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert set(out) == set(docs)
    left = _lines_left(r.text for r in out.values())
    assert set(left.values()) == {1}  # of equal lines one stays
    before = _lines_left(docs.values())
    assert set(left) <= set(before)
    for i, r in out.items():
        was, now = docs[i].split("\n"), r.text.split("\n")
        assert r.n_lines == len(was) and r.n_removed == len(was) - len(now) or r.text == ""
        it = iter(was)
        assert r.text == "" or all(x in it for x in now)  # what stays keeps its order
    assert QUERIES["op5_line_dedup"](spark, sf).count() == len(docs)


def near_lines(lines):
    """Pairs of lines of edit similarity 0.9, by the edit distances of another engine."""
    con = duckdb.connect()
    con.execute("CREATE TABLE l (i BIGINT, t VARCHAR)")
    con.executemany("INSERT INTO l VALUES (?, ?)", list(enumerate(lines)))
    return con.sql("""SELECT x.i, y.i FROM l x JOIN l y ON x.i < y.i AND abs(length(x.t) - length(y.t)) <= greatest(length(x.t), length(y.t)) * 0.1
                      WHERE levenshtein(x.t, y.t) <= greatest(length(x.t), length(y.t)) * 0.1 + 1e-9""").fetchall()


def test_line_dedup_fuzzy_groups_like_brute_force(spark):
    rnd = random.Random(8)
    lines = []
    for n in (7, 18, 30, 60, 120):
        for _ in range(3):
            b = words_of(rnd, n, 5000)
            for k in range(12):
                w = b.split()
                if k:
                    w[rnd.randrange(len(w))] = f"w{rnd.randrange(10**4)}"
                if k > 8:
                    del w[rnd.randrange(len(w))]
                lines.append(" ".join(w))
    rnd.shuffle(lines)
    root = groups_of(range(len(lines)), near_lines(lines))
    rows = [(i, f"short line\n{x}") for i, x in enumerate(lines)]
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {i: int(root[i] != i) for i in root} and sum(got.values()) > 100


def test_line_dedup_of_one_large_group_and_a_common_phrase(spark):
    rnd = random.Random(2)
    base, phrase = words_of(rnd, 40, 5000).split(), words_of(rnd, 12, 5000)
    lines = []
    for k in range(300):
        w = [*base]
        for _ in range(k % 4):  # some are too far from the first, but not from one another
            w[rnd.randrange(40)] = f"w{rnd.randrange(5000)}"
        lines.append(" ".join(w))
    lines += [f"{words_of(rnd, 20, 5000)} {phrase} {words_of(rnd, 20, 5000)}" for _ in range(300)]
    root = groups_of(range(len(lines)), near_lines(lines))
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(documents(spark, list(enumerate(lines)))).collect()}
    wrong = sum(got[i] != int(root[i] != i) for i in root)
    assert wrong <= 3 and not any(got[i] for i in range(300, 600))


@pytest.mark.parametrize("share, least", [(0.03, 0.95), (0.05, 0.9)])
def test_line_dedup_finds_changed_letters(spark, share, least):
    rnd = random.Random(11)
    lines = []
    for n in (8, 12, 25, 60, 150):
        for _ in range(30):
            x = words_of(rnd, n, 50_000)
            y = list(x)
            for p in rnd.sample(range(len(y)), max(1, int(len(y) * share))):
                y[p] = rnd.choice("abcdef") if y[p] != " " else " "
            lines += [x, "".join(y)]
    gone = {r.doc_id for r in linededup.dedup_lines(documents(spark, list(enumerate(lines)))).collect() if r.n_removed}
    pairs = {b for a, b in near_lines(lines)}
    assert len(gone & pairs) >= least * len(pairs) and gone <= pairs


def _edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        new = [i]
        for j, b in enumerate(y, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[-1]


def test_line_dedup_edges(spark):
    line = "this line has more than five words"
    rows = [*EDGES, (8, f"{line}\n{line.upper()}!\nother"), (9, line)]
    out = linededup.dedup_lines(documents(spark, rows))
    assert out.columns[: len(documents(spark, []).columns) - 1] == [c for c in documents(spark, []).columns if c != "n_lines"]
    got = {str(r.doc_id): r.text for r in out.collect()}
    assert got["1"] is None and got["2"] == "" and got["8"] == f"{line}\nother" and got["9"] == ""
    assert got["5"] == "a b c d e f g h" and len(got["6"]) == 200_000 and out.count() == len(rows)
    assert linededup.dedup_lines(documents(spark, [])).count() == 0


@pytest.mark.parametrize("words", [8, 20, 60])
def test_line_dedup_finds_changed_words_at_every_length(spark, words):
    rnd = random.Random(words)
    lines = []
    for _ in range(60):
        w = [f"expression{rnd.randrange(10**5)}" for _ in range(words)]
        changed = [*w]
        changed[rnd.randrange(words)] = f"different{rnd.randrange(10)}"[: 10]
        lines += [" ".join(w), " ".join(changed)]
    alike = {i for i in range(0, 120, 2) if _edits(lines[i], lines[i + 1]) <= max(len(lines[i]), len(lines[i + 1])) * 0.1 + 1e-9}
    gone = {r.doc_id for r in linededup.dedup_lines(documents(spark, list(enumerate(lines)))).collect() if r.n_removed}
    assert len(gone) >= 0.95 * len(alike) and gone <= {i + 1 for i in alike} and (alike or words == 8)


def test_line_dedup_links_very_long_lines(spark):
    rnd = random.Random(4)
    long = words_of(rnd, 16_380, 50_000)
    changed = f"{long[:50_000]} {words_of(rnd, 200, 50_000)} {long[50_001:]}"  # over 1,000 edits, and over 16,383 words
    out = linededup.dedup_lines(documents(spark, [(1, long), (2, changed), (3, words_of(rnd, 16_390, 50_000))]))
    assert len(changed) - len(long) > 1000 and {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 1, 3: 0}


def _share_runs(x, y):
    """An eighth of the twos (lines of up to 19 words) or a tenth of the threes (from 16 words) in common, at least one."""
    x, y = x.split(), y.split()
    for size, least, most, part in ((2, 0, 20, 8), (3, 16, 1 << 31, 10)):
        if least <= len(x) < most and least <= len(y) < most:
            a, b = ({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} for w in (x, y))
            if len(a & b) >= max(1, max(len(a), len(b)) // part):
                return True
    return False


def test_line_dedup_loses_no_link_however_spread_the_changes_and_common_the_runs(spark):
    rnd = random.Random(21)
    common = [words_of(rnd, 3, 300) for _ in range(12)]  # every run of some lines is in dozens of others
    lines = []
    for n in (8, 18, 40, 80, 150):
        for _ in range(14):
            x = words_of(rnd, n, 50_000) if rnd.random() < 0.6 else " ".join(rnd.choice(common) for _ in range(n // 3 + 1))
            y = list(x)
            for p in rnd.sample(range(len(y)), int(len(y) * 0.085)):
                y[p] = rnd.choice("abcdef") if y[p] != " " else " "
            lines += [x, "".join(y)]
    lines = list(dict.fromkeys(lines))
    linked = [(a, b) for a, b in near_lines(lines) if _share_runs(lines[a], lines[b])]
    root = groups_of(range(len(lines)), linked)
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(documents(spark, list(enumerate(lines)))).collect()}
    assert got == {i: int(root[i] != i) for i in root} and sum(got.values()) > 40


def test_line_dedup_by_bands_of_length_loses_no_link(spark, monkeypatch):
    for name, value in (("ONE_BAND", 0), ("LARGE", 1), ("FEW", 0), ("ROUNDS", 1)):
        monkeypatch.setattr(linededup, name, value)
    rnd = random.Random(31)
    lines = []
    for n in range(8, 40):  # every length is near some band's end
        x = words_of(rnd, n, 900)
        y = x[: int(len(x) * 0.93)].strip() + ("" if n % 2 else " " + words_of(rnd, 1, 900))
        lines += [x, y, f"{x} {words_of(rnd, max(1, n // 14), 900)}"]
    lines = list(dict.fromkeys(lines))
    root = groups_of(range(len(lines)), [(a, b) for a, b in near_lines(lines) if _share_runs(lines[a], lines[b])])
    rows = [*enumerate(lines), (0, lines[0])]  # a row that repeats counts as one
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {i: int(root[i] != i) for i in root} and sum(got.values()) > 40
    widths = spark.createDataFrame([(i, len(x), x) for i, x in enumerate(lines)], "id long, width int, line string")
    assert len(linededup._bands(widths)) == linededup.BANDS


def test_line_dedup_leaves_only_lines_of_fitting_length_in_a_block(spark):
    rows = [(1, 10, 100), (1, 11, 95), (1, 12, 50), (2, 10, 100), (2, 12, 50), (3, 13, 100), (4, 10, 100), (4, 10, 100), (4, 14, 91)]
    got = linededup._met(spark.createDataFrame(rows, "block long, id long, width int"), linededup.Settings())
    assert {(r.block, r.id) for r in got.collect()} == {(1, 10), (1, 11), (4, 10), (4, 14)} and got.count() == 4


def test_line_dedup_groups_all_bands_in_one_set_of_rounds(spark, monkeypatch):
    for name, value in (("ONE_BAND", 0), ("LARGE", 1), ("FEW", 0), ("ROUNDS", 1)):
        monkeypatch.setattr(linededup, name, value)
    calls, plain = [], linededup.components
    monkeypatch.setattr(linededup, "components", lambda links: calls.append(1) or plain(links))
    rnd = random.Random(41)
    lines = [x + end for x in [words_of(rnd, n, 900) for n in range(8, 40, 4)] for end in ("", "s")]
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(documents(spark, list(enumerate(lines)))).collect()}
    assert got == {i: i % 2 for i in range(len(lines))} and len(calls) == linededup.ROUNDS + 1


def test_line_dedup_tells_lines_apart_by_more_letters_than_blocks_have():
    assert len(linededup.LETTERS) == len(linededup.MORE) == 9 and not set(linededup.LETTERS) & set(linededup.MORE)


def test_line_dedup_compares_pairs_in_slices_and_leaves_nothing_it_has_used(spark, monkeypatch, tmp_path):
    for name, value in (("ONE_BAND", 0), ("BANDS", 2), ("PAIRS", 1), ("PAIRS_A_ROW", 1)):
        monkeypatch.setattr(linededup, name, value)
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    rnd = random.Random(47)
    lines = []
    for n in (9, 30):
        for x in [words_of(rnd, n, 900) for _ in range(3)]:
            lines += [x + 2 * end for end in "abcdefgh"]
    slices, plain = [], linededup._apart
    monkeypatch.setattr(linededup, "_apart", lambda blocks, settings, k, n: slices.append((k, n)) or plain(blocks, settings, k, n))
    out = linededup.dedup_lines(documents(spark, list(enumerate(lines))))
    assert slices[: slices[0][1]] == [(k, slices[0][1]) for k in range(slices[0][1])] and all(n > 1 for _, n in slices)
    assert {r.doc_id: r.n_removed for r in out.collect()} == {i: int(i % 8 > 0) for i in range(len(lines))}
    left = [f.parent for f in tmp_path.rglob("*.parquet")]
    assert len(set(left)) == 1  # the lines to remove


def test_line_dedup_parts_unlike_lines_with_a_run_in_common_where_they_meet(spark):
    rnd = random.Random(53)
    kinds = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(4000)]
    lines = [" ".join(["same", "pair", *(rnd.choice(kinds) for _ in range(8))]) for _ in range(60)]
    lines += [x[:20] + "zq" + x[22:] for x in lines]
    rows = spark.createDataFrame([(i, len(x), 10, x) for i, x in enumerate(lines)], "id long, width int, kinds int, line string")
    settings = linededup.Settings()
    pairs = linededup._apart(linededup._rooted(linededup._blocks(rows, settings), None), settings, 0, 1)
    got = {(r.a, r.b) for r in pairs.collect()}
    linked = {(a, b) for a, b in near_lines(lines) if _share_runs(lines[a], lines[b])}
    assert linked and linked <= got and len(got) <= 3 * len(linked)  # nearly 3,000 share the pair and fit in length


def test_line_dedup_places_the_runs_that_fingerprints_have(spark):
    rnd = random.Random(43)
    lines = [words_of(rnd, n, 12) for n in (1, 2, 3, 5, 15, 16, 19, 20, 21, 60)] + ["".join(chr(0x4E00 + rnd.randrange(40)) for _ in range(60))]
    rows = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    told = rows.select("id", "line", F.explode(F.array(linededup._told_by("line"))).alias("words"))
    sorts = told.select("id", F.explode(linededup.fingerprints(F.col("words"))).alias("sort"))
    whole = {(r.id, r.block): r.common for r in sorts.select("id", F.explode("sort.runs").alias("block"), linededup.least_common("sort.n", F.get("sort.runs", F.lit(0))).alias("common")).collect()}
    kinds = told.select("id", F.length("line").alias("width"), F.size(F.array_distinct("words")).alias("kinds"), "line")
    got = {(r.id, r.block): r.common for r in linededup._placed_runs(kinds).collect()}
    assert set(got) == set(whole) and all(1 <= got[k] <= whole[k] for k in got)


def test_line_dedup_takes_lines_without_spaces(spark):
    rnd = random.Random(5)
    line = "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(60))
    out = linededup.dedup_lines(documents(spark, [(1, line), (2, line), (3, line[:30] + "一" + line[31:]), (4, line[::-1]), (5, "短"), (6, "短")]))
    assert {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0}


def test_decontamination_matches_oracle(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(ORACLES["op4_decontamination"])
    cols = want.columns
    got = sorted(tuple(r[c] for c in cols) for r in QUERIES["op4_decontamination"](spark, sf).collect())
    assert got == sorted(want.fetchall()) and got


def test_decontamination_finds_items_in_long_documents(spark):
    rnd = random.Random(9)
    items = [(k, words_of(rnd, n, 5000)) for k, n in enumerate((5, 9, 30, 70, 200))] + [(90, "too short"), (91, None), (92, "")]
    rows = [(i, words_of(rnd, 3000, 5000)) for i in range(6)] + [(10 + k, f"{words_of(rnd, 2500)}. {t.upper()} {words_of(rnd, 2000)}") for k, t in items[:5]]
    half = items[3][1].split()
    rows.append((20, words_of(rnd, 400) + " " + " ".join(half[: len(half) // 2])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contaminated(documents(spark, rows), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.containment) for r in found) == [(10 + k, k, 1.0) for k in range(5)]
    left = decontam.decontaminated(documents(spark, [*rows, *EDGES]), bench)
    assert left.columns == documents(spark, []).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in [*rows, *EDGES] if i not in range(10, 15))
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(documents(spark, rows), none).count() == 0
    assert decontam.contaminated(documents(spark, []), bench).count() == 0


def test_nearest_neighbours_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in QUERIES["op2_nearest_neighbours"](spark, sf).collect():
        got.setdefault(r.query_id, []).append(r)
    asked = [i for i in ids if i % 20 == 0]
    assert set(got) == set(asked)
    hit = 0
    for q in asked:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        rows = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and len({r.vec_id for r in rows}) == 20
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert np.allclose([r.score for r in rows], [s[ids == r.vec_id][0] for r in rows], atol=1e-12)
        hit += len({r.vec_id for r in rows} & set(ids[np.lexsort((ids, -s))[:20]]))
    assert hit >= 0.9 * 20 * len(asked)


def test_nearest_neighbours_edges(spark):
    schema = "vec_id long, embedding array<float>, rank int, query_id long"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (None, [1.0, 1.0]), (20, [0.0, 2.0]), (9, [1.0, 2.0, 3.0]), (0, [1.0, 0.0]), (10, [])]
    df = spark.createDataFrame([(i, v, 7, 7) for i, v in rows], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0), (0, 4, 20, 0.0), (20, 1, 3, 2.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    same = spark.createDataFrame([(i, [3.0, 4.0], 0, 0) for i in range(500)], schema)
    near = ann.search(same, F.col("vec_id") == 100, ann.Settings(leaf=16)).collect()
    assert [r.vec_id for r in sorted(near, key=lambda r: r["rank"])] == list(range(20))


def test_nearest_neighbours_are_the_same_in_many_small_blocks_and_chunks(spark):
    rng = np.random.default_rng(59)
    x = np.round(rng.normal(size=(1500, 8)) + rng.integers(0, 4, size=(1500, 1)), 2).astype(np.float32)
    rows = spark.createDataFrame([(i * 7, x[i].tolist()) for i in range(len(x))], "vec_id long, embedding array<float>")
    find = lambda **held: sorted(tuple(r) for r in ann.search(rows, F.col("vec_id") % 4 == 0, ann.Settings(leaf=32, **held)).collect())
    many = find(held=2_000, asked=9, scored=40)
    assert many == find() and len(many) == 375 * 20


def test_nearest_neighbours_send_a_query_once_a_block_however_many_leaves_it_opens(spark, monkeypatch):
    rng = np.random.default_rng(61)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    rows = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "vec_id long, embedding array<float>")
    path, plain = [], ann.Scratch.written
    monkeypatch.setattr(ann.Scratch, "written", lambda self, df: path.append(self) or plain(self, df))
    assert ann.search(rows, F.col("vec_id") % 2 == 0, ann.Settings(leaf=16)).count() == 1500 * 20
    assert len(path) == 3  # rows, those that are indexed, those that ask
    ids = np.arange(700, dtype=np.int64)
    packs = ann._packs(ann._dealt(ids, 5), "block", ids=ids, vectors=x[:700])
    assert packs.num_rows == 5 and sum(len(b) for b in packs["vectors"].to_pylist()) == x[:700].nbytes
    got = np.concatenate([np.frombuffer(b, np.int64) for b in packs["ids"].to_pylist()])
    assert sorted(got) == list(ids)


def _auc(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    return (rank[label == 1].mean() - rank[label == 0].mean()) / len(score) + 0.5


def _labelled(spark, seed=11, n=600):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rnd.random() < 0.25
        w = words_of(rnd, rnd.choice([20, 80, 300]), 3000).split()
        if bad:
            for _ in range(rnd.randint(1, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(["vile", "nasty", "foul", "rotten"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(rnd.random() < 0.8), int(bad)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity_separates_held_out_documents(spark):
    docs, labels, marks = _labelled(spark)
    learnt = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, learnt).collect()}
    held = [(got[i].score, t) for i, _, t in marks if got[i].held_out]
    assert _auc(np.array([s for s, _ in held]), np.array([t for _, t in held])) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    # Held-out labels teach nothing.
    changed = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.learn(docs, changed)
    assert np.allclose(learnt.weights, again.weights)
    assert all((x == y).all() for a, b in zip(learnt.sent.value.tables, again.sent.value.tables) for x, y in zip(a, b))


def plain_models(train, settings):
    """Exact Kneser-Ney counts of (text, toxic) in dictionaries, each text and label once; log-ratios by the formulas as they stand."""
    n, m = {}, {}
    for text, toxic in set(train):
        for w in set(toxicity.WORD.findall(text.lower())):
            for d, k in ((n, w), (m, w[: settings.stem])):
                d.setdefault(k, [0, 0])[toxic] += 1
    sums = [[sum(v[c] for v in d.values()) for c in (0, 1)] for d in (n, m)]
    kinds = [[sum(v[c] > 0 for v in d.values()) for c in (0, 1)] for d in (n, m)]
    cut = lambda x: [0.0, *settings.discounts][min(int(x), 3)]

    def log_ratio(w):
        a, b = n.get(w, [0, 0]), m.get(w[: settings.stem], [0, 0])
        pooled = (sum(b) + 1) / (sum(max(x, 1) for x in sums[1]) + sum(kinds[1]) + 1)
        share = (sum(a) + 1) / (sum(b) + 2)
        p = []
        for c in (0, 1):
            top, low = max(sums[0][c], 1), max(sums[1][c], 1)
            stem = max(b[c] - cut(b[c]), 0) / low + (cut(1) * kinds[1][c] + 1) / (low + 1) * pooled
            p.append(max(a[c] - cut(a[c]), 0) / top + (cut(1) * kinds[0][c] + 1) / (top + 1) * stem * share)
        return math.log(p[1]) - math.log(p[0])

    return log_ratio


@pytest.mark.parametrize("settings", [toxicity.Settings(), toxicity.Settings(small_counts=0, salts=3)])
def test_toxicity_equals_plain_kneser_ney(spark, settings):
    """Whatever the way counts meet texts: evidence is that of exact counts, and so are scores."""
    docs, labels, _ = _labelled(spark, n=120)
    learnt = toxicity.learn(docs, labels, settings)
    assert (learnt.sent is None) == (settings.small_counts == 0)
    toxic = {r.doc_id: r.toxic for r in labels.filter(~toxicity.held_out()).collect()}
    rows = {r.doc_id: r.text for r in docs.collect()}
    log_ratio = plain_models([(t, toxic[i]) for i, t in rows.items() if i in toxic], settings)
    for r in toxicity.score(docs, learnt, settings).collect():
        x = [log_ratio(w) for w in toxicity.WORD.findall(rows[r.doc_id].lower())]
        assert (r.whole, r.passage) == pytest.approx((sum(x) / len(x), max(x)))
        z = learnt.weights @ [1, sum(x) / len(x), max(x), math.log(len(x))]
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)))
    got = {r.doc_id: r.score for r in toxicity.score(documents(spark, EDGES), learnt, settings).collect()}
    assert len(got) == len({i for i, _ in EDGES}) and got[1] == got[2]


def test_toxicity_counts_stay_exact_with_millions_of_words(spark):
    """Other documents' vocabulary, however large, changes no word's counts."""
    docs, labels, _ = _labelled(spark, n=60)
    few = toxicity.learn(docs, labels).sent.value
    many = spark.range(0, 300).select((F.col("id") + 10_000).alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(0, 9999), x -> concat('x', hex(id * 10000 + x))))").alias("text"))
    marks = many.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    every = toxicity.learn(docs.select("doc_id", "text").union(many), labels.union(marks.select(*[F.col(c).cast(labels.schema[c].dataType) for c in labels.columns])))
    words = ["vile", "nasty", *(f"w{i}" for i in range(3000))]
    keys = np.array([toxicity.keys_of(w, 4)[0] for w in words], np.uint64)
    assert (few.counts(keys, 0) == every.sent.value.counts(keys, 0)).all() and len(every.sent.value.tables[0][0]) > 2_000_000


def test_toxicity_query(spark, sf):
    out = QUERIES["op1_toxicity"](spark, sf)
    assert [f.dataType.simpleString() for f in out.schema][:4] == ["bigint", "boolean", "double", "int"]
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_toxicity_edges(spark):
    docs, labels, _ = _labelled(spark, n=40)
    learnt = toxicity.learn(docs, labels)
    got = toxicity.score(documents(spark, EDGES), learnt).collect()
    assert len(got) == len(EDGES) and all(math.isfinite(r.score) for r in got)
    assert toxicity.score(documents(spark, []), learnt).count() == 0
    for some in (labels.limit(0), labels.filter("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert all(0 <= r.score <= 1 for r in toxicity.score(docs, toxicity.learn(docs, some)).collect())


def test_quality_on_held_out_documents(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    got = [r for r in QUERIES["op9_quality_classifier"](spark, big).collect() if r.held_out and r.doc_id in marks]
    label = np.array([marks[r.doc_id] for r in got])
    assert _auc(np.array([r.p_good for r in got]), label) > 0.97
    rejected = [marks[r.doc_id] for r in got if not r.accepted]
    assert sum(rejected) <= 0.02 * label.sum() and len(rejected) - sum(rejected) > 0.6 * (1 - label).sum()


def test_quality_posteriors_shrink_to_what_is_above(spark):
    rows = [("a", "x", 1)] * 90 + [("a", "x", 0)] * 10 + [("b", "x", 0)] * 60 + [("b", "x", 1)] * 40 + [("c", "x", 0)]
    seen = spark.createDataFrame(rows, "host string, path string, good int")
    table, corpus = quality.sites(seen)
    got = {r.host: (r.host_good, r.path_good) for r in table.collect()}
    assert 0.4 < got["b"][0] < corpus < got["a"][0] < 0.9
    assert 0.1 < got["c"][0] < corpus  # one bad document moves its host, but not to nothing


def test_quality_edges(spark):
    docs, labels, _ = _labelled(spark, n=40)
    rows = documents(spark, EDGES)
    got = quality.classify(rows, labels).collect()
    assert len(got) == len(EDGES) and all(0 < r.p_good < 1 for r in got)
    assert quality.accepted(rows, labels).columns == rows.columns
    assert quality.classify(rows.limit(0), labels).count() == 0
    assert quality.accepted(docs, labels.limit(0)).count() == docs.count()
    nowhere = rows.withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string"))
    assert quality.classify(nowhere, labels).count() == len(EDGES)
