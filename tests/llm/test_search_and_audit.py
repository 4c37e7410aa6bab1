"""Nearest neighbours, filter audit and lexical search against brute force, and on odd input."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from hazeline.llm import filter_audit, lexical, nearest

# --- nearest neighbours --------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, v string, ids int, cell string, slot int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2, "c", 3) for i, v in rows], VECTORS)


def brute_nearest(rows, top=20):
    """``(query, rank, id, score)`` by all products; each id has its best score."""
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        best = {}
        for own in (v for i, v in good if i == q):
            for i, v in good:
                if i != q and len(v) == len(own):
                    best[i] = max(best.get(i, -math.inf), float(np.dot(np.float32(own).astype(float), np.float32(v).astype(float))))
        ranked = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:top]
        out += [(q, k + 1, i, s) for k, (i, s) in enumerate(ranked)]
    return out


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_one_cell_is_exact_with_ties_and_copies(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randint(-2, 2) for _ in range(4)]) for i in range(300)]  # many ties, exact products
    rows += [(1000 + i, [1, 2, 0, 1]) for i in range(60)] + [(2000 + i, [1, 2, 0, 1, 0]) for i in range(3)]
    assert found(nearest.nearest(vectors(spark, rows))) == brute_nearest(rows)


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1, 0]), (0, [1, 0]), (1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [float("nan"), 1]), (6, [float("inf"), 1]),
            (None, [1, 1]), (7, [2, 0]), (7, [3, 0]), (20, [-1, 0]), (-20, [0.5, 0]), (8, [1, 1, 1]), (40, [5, 5, 5, 5])]
    got = found(nearest.nearest(vectors(spark, rows)))
    assert got == brute_nearest(rows)
    assert {r[0] for r in got} == {0, 20, -20} and (0, 1, 7, 3.0) in got
    long = [(0, [1.0] * 3000), (1, [2.0] * 3000)]
    assert found(nearest.nearest(vectors(spark, long))) == [(0, 1, 1, 6000.0)]


def test_no_vectors(spark):
    assert nearest.nearest(vectors(spark, [])).count() == 0
    assert nearest.nearest(vectors(spark, [(1, [1.0])])).count() == 0


@pytest.mark.parametrize("spread", [1.0, 0.2])
def test_many_cells_reach_the_recall(spark, monkeypatch, spread):
    """Vectors of different lengths in the plane of norms, clusters and a narrow cone; small cells and blocks."""
    for name, value in (("CELL", 64), ("BLOCK", 100), ("SLICE", 7)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(2)
    matrix = np.array([1.0] * 12) + spread * rng.standard_normal((1500, 12))
    matrix[:500] = matrix[0] + 0.01 * rng.standard_normal((500, 12))  # a third in one place
    matrix *= rng.uniform(0.5, 2, (1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    got = found(nearest.nearest(vectors(spark, rows)))
    wanted = brute_nearest(rows)
    assert len(got) == len(wanted)
    hit = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in wanted})
    assert hit >= 0.9 * len(wanted)
    scores = {(q, i): s for q, _, i, s in wanted}
    assert all(abs(scores[q, i] - s) < 1e-9 for q, _, i, s in got if (q, i) in scores)


def test_queries_that_find_too_few_search_all_rows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 8)
    monkeypatch.setattr(nearest, "probes", lambda p, *rest, **more: np.zeros((0, len(p)), dtype=np.int64))
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((90, 3)))]
    got = found(nearest.nearest(vectors(spark, rows)))
    assert len(got) == len(brute_nearest(rows))
    short = {q for q, *_ in got}
    assert short == {0, 20, 40, 60, 80}


def test_probes_come_by_chance_and_cover(spark):
    rng = np.random.default_rng(4)
    p, low, width = rng.standard_normal(3), -rng.random(3), np.array([0.7, 1.0, 2.0])
    cells = nearest.probes(p, 0.6, low, width, covered=0.8)
    draws = 0.6 * p + 0.8 * rng.standard_normal((200_000, 3))
    places = Counter(map(tuple, np.floor((draws - low) / width).astype(int)))
    share = [places[tuple(c)] / 200_000 for c in cells]
    assert 0.79 <= sum(share) and sum(share[:-1]) < 0.81
    assert all(a >= b - 0.01 for a, b in zip(share, share[1:]))


def test_recall_measures(spark):
    rows = [(i, [math.cos(i), math.sin(i)]) for i in range(200)]
    df = vectors(spark, rows)
    exact = nearest.nearest(df)
    assert nearest.recall(exact, df) == 1.0
    assert abs(nearest.recall(exact.where("rank <= 10"), df) - 0.5) < 0.01


# --- filter audit --------------------------------------------------------------------------

DOCUMENTS = "doc_id long, text string, lang string, source string, bits int, part string, digest string, n int, bucket int"


def written(spark, rows, folder, files=3):
    """Documents with clashing columns, dealt to files so that small ids come late."""
    full = [(i, t, lang, None, 1, "p", "d", 2, 3) for i, t, lang in rows]
    for k in range(files):
        own = [r for j, r in enumerate(full) if j % files == k]
        spark.createDataFrame(own, DOCUMENTS).coalesce(1).write.mode("append").parquet(folder)
    return folder


def brute_audit(rows, labels):
    seen = {}
    for i, t, _ in rows:
        if i is not None:
            seen[t or ""] = min(seen.get(t or "", i), i)
    masks = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, bad in (("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)),
                                  ("C", 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)), ("D", re.search("[#$%&*|]", t)),
                                  ("E", i is not None and i > seen[t])) if bad}
        marks = [(q, x) for d, q, x in labels if d == i and i is not None]
        masks.append((lang or "", fails, any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    out = {}
    orders = list(itertools.permutations("ABCDE"))
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        shapley = Counter()
        for order in orders:
            kept = own
            for step, f in enumerate(order, 1):
                gone = [m for m in kept if f in m[1]]
                kept = [m for m in kept if f not in m[1]]
                failing = [m for m in own if f in m[1]]
                out[part, "".join(order), step] = [len(kept), len(gone), len(failing) - len(gone), sum(m[1] == {f} for m in own),
                                                   sum(m[2] for m in gone), sum(m[3] for m in gone)]
                shapley[f] += len(gone)
        for order in orders:
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return {k: tuple(v) for k, v in out.items()}


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(spark, folder, labels, batches):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.audited(spark, folder, marks, batches).collect()
    assert len({(r["part"], r["filter_order"], r["step"]) for r in rows}) == len(rows)
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[f] for f in FIGURES) for r in rows}


def texts(count=120, seed=6):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["alpha", "Beta", "x#", "GAMMA"] + [f"w{k}" for k in range(v)]) for _ in range(n))
            for n, v in [(250, 400), (250, 20), (30, 50), (220, 300), (199, 500), (200, 500)]]
    rows = [(rng.randrange(10_000), rng.choice(pool) + rng.choice(["", "", " |", f" {rng.random()}"]), rng.choice(["en", "de", None]))
            for _ in range(count)]
    return rows + [(5000 - k, "the same text", "en") for k in range(60)] + rows[:5]


def test_audit_is_the_same_for_any_dealing_of_rows(spark, tmp_path):
    rows = texts()
    labels = [(i, k % 2, k % 3) for k, (i, _, _) in enumerate(rows[::2])]
    wanted = brute_audit(rows, labels)
    for files, batches, order in ((1, 1, 1), (6, 6, 1), (6, 3, -1)):
        folder = written(spark, rows[::order], str(tmp_path / f"{files}{batches}{order}"), files)
        assert audit(spark, folder, labels, batches) == wanted


def test_audit_of_odd_rows(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, None, "en"), (2, "", "en"), (None, "", "en"), (None, None, None), (3, " \n", "de"), (9, long, "de"), (4, long, None),
            (4, long, "en"), (7, "Ä" * 50 + "A", "xx"), (8, "|", "xx"), (8, "|", "xx"), (8, "other", "xx")]
    labels = [(4, 1, 0), (4, 0, 1), (None, 1, 1), (8, None, 1), (9, 1, None), (77, 1, 1)]
    assert audit(spark, written(spark, rows, str(tmp_path / "docs"), 4), labels, 4) == brute_audit(rows, labels)


def test_audit_of_an_empty_table_and_one_file(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).coalesce(1).write.parquet(str(tmp_path / "none"))
    assert audit(spark, str(tmp_path / "none"), [], 2) == {}
    folder = written(spark, [(2, "a b", "en"), (1, "a b", "en")], str(tmp_path / "one"), 1)
    (file,) = [p for p in (tmp_path / "one").iterdir() if p.name.endswith(".parquet")]
    assert audit(spark, str(file), [], 2) == brute_audit([(2, "a b", "en"), (1, "a b", "en")], []) == audit(spark, folder, [], 1)


# --- lexical search ------------------------------------------------------------------------

CLASHING = ", term string, at string, score long, rank int, shard string, no_id boolean"


def search(spark, docs, items, top=20, partitions=3):
    d = spark.createDataFrame([(i, t, "a", "b", 1, 2, "c", True) for i, t in docs], f"doc_id long, text string{CLASHING}")
    i = spark.createDataFrame([(i, t, "a", "b", 1, 2, "c", True) for i, t in items], f"item_id long, text string{CLASHING}")
    rows = lexical.searched(d.repartition(partitions), i, top).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=repr)


def brute_search(docs, items, top=20):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    bags = [(i, Counter(re.findall(pattern, lower(t)))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in set(items):
        wanted.setdefault(i, Counter()).update(re.findall(pattern, lower(t)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for (doc_id, bag), n in zip(bags, sizes):
            m = 75 + (25 * n * n_docs) // n_terms if n_terms else 0
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t, times in terms.items() if t in bag
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top]
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(best)]
    return sorted(out, key=repr)


def collection(count=400, seed=8):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(rng.randrange(10**6), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for _ in range(count)]
    docs += [(10 + k, "t1 t2 t1 same") for k in range(40)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30)))) for k in range(12)]
    return docs, items


@pytest.mark.parametrize("sizes", [(32_768, 128, 512), (64, 4, 8), (7, 1, 3)])
def test_search_is_exact_for_any_shards_blocks_and_windows(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD", "POSTINGS", "FIRST_WINDOW"), sizes):
        monkeypatch.setattr(lexical, name, value)
    docs, items = collection()
    assert search(spark, docs, items) == brute_search(docs, items)
    assert search(spark, docs, items, top=3, partitions=1) == brute_search(docs, items, 3)


def test_search_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TERMS_AT_ONCE", 20)
    docs, items = collection(100)
    assert search(spark, docs, items) == brute_search(docs, items)


def test_search_of_odd_rows(spark):
    long = "needle " + " ".join(f"word{i}" for i in range(50_000)) + " needle"
    docs = [(1, None), (2, ""), (3, ".,;"), (4, "Needle ÄPFEL"), (5, "needle"), (5, "needle"), (None, "needle"), (6, long), (7, "x9 äpfel")]
    items = [(1, "NEEDLE, needle"), (1, "NEEDLE, needle"), (1, "x9"), (2, None), (3, ""), (None, "needle ÄPFEL"), (4, "absent")]
    assert search(spark, docs, items) == brute_search(docs, items)
    assert search(spark, [], items) == [] and search(spark, docs, []) == []
    assert search(spark, [(1, "same"), (2, "same")], [(1, "same")]) == brute_search([(1, "same"), (2, "same")], [(1, "same")])


def test_blocks_are_skipped_without_decompressing(spark):
    """A rare term decides; blocks of a common one open only where the rare one is."""
    size = 20_000
    lengths = np.full(size, 100, dtype=np.int64)
    stats = lexical.Statistics(size, 100 * size, {"common": size, "rare": 40})
    every, few = np.arange(size), np.arange(0, size, 500)
    made = {
        t: lexical._List(*lexical._blocks(n, np.ones(len(n), dtype=np.int64), lengths[n]), stats.weight(t), stats, lengths)
        for t, n in (("common", every), ("rare", few))
    }
    best = lexical.best_of_shard([(made["common"], 1), (made["rare"], 1)], size)
    assert [n for _, n in best] == few[:20].tolist()
    assert len(made["common"].opened) < 20 < len(made["common"].first)


def test_packing_round_trips():
    for values in ([], [0], [255], [256, 3], [70_000], [2**40, 1]):
        assert lexical.unpacked(lexical.packed(np.array(values, dtype=np.int64))).tolist() == values
