"""Chunk recipes, spelling variants and hard negatives against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import chunk_recipes, hard_negatives, spelling

DOCS = "doc_id long, text string, hash string, row int, n string, size int, recipe int, gone_id int, kept int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "h", 1, "n", 2, 3, 4, 5) for i, t in rows], DOCS)


# ------------------------------------------------------------- chunk recipes

def texts(seed):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdé日 ½\n") for _ in range(r.randint(0, 120))) for _ in range(25)]
    out = [None, "", " \t\n\x0b\f\r", " ", "x", "xx", "日本語" * 60, "日本語" * 60 + "!"]
    for t in base:
        out += [t, t.replace("a", " a\t", 2), "  " + t, t[:-1], t + "b"]
    return out


def copies(rows):
    groups = collections.defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i, k))
    return {plain: sorted(g, key=lambda x: (x[0], x[1], x[2] or 0)) for plain, g in groups.items()}


@pytest.mark.parametrize("bits", [64, 8, 1])
def test_exact_duplicates(spark, bits):
    """With hashes of a few bits most chunks share theirs, and nothing changes."""
    made = texts(3)
    rows = list(enumerate(made)) + [(3, made[3]), (9, made[9]), (9, made[9]), (None, made[10]), (None, "only null")]
    got = chunk_recipes.exact_duplicates(documents(spark, rows), min_chunk=6, bits=bits).collect()
    want, groups = collections.Counter(), copies(rows)
    for i, t in rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        group = groups[plain]
        want[(i, group[0][2], len(group), hashlib.sha256(plain.encode()).hexdigest())] += 1
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    left = chunk_recipes.drop_exact_duplicates(documents(spark, rows))
    assert left.columns == DOCS.replace(",", "").split()[::2]
    assert {r["doc_id"] for r in left.collect()} == {g[0][2] for g in groups.values()} | {None}


def test_recipes_of_an_empty_table(spark):
    assert chunk_recipes.exact_duplicates(documents(spark, [])).count() == 0


def test_cuts_follow_the_content(spark):
    r = random.Random(5)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "".join(chr(0x4E00 + 7 * k) for k in range(500))):
        text = "".join(r.choice(alphabet) for _ in range(6000))
        moved = text[:2000] + alphabet[:3] + text[2000:]
        a, b = (x[0] for x in spark.createDataFrame([(0, text), (1, moved)], "i int, t string").orderBy("i")
                .select(chunk_recipes.chunks_of(F.col("t"), 100)).collect())
        assert b"".join(c.encode("latin-1") for c in a) == text.encode() and all(len(c) >= 100 for c in a[:-1])
        assert len(a) > 15 and len(set(a) & set(b)) >= len(a) - 4


# ------------------------------------------------------------------ spelling

def spelled(rows):
    """{word: (form, root, n, n_near, form_n)} by the contract."""
    count = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            count[w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    mates = {w: [v for v in words if v != w and near(v, w)] for w in words}
    form = {}
    for w, vs in mates.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 10 * words[w]:
            form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(mates[w]), words[form[w]] if w in form else None)
    return out


def misspelt(seed, n=60):
    r = random.Random(seed)
    stems = ["".join(r.choice("abÀ×é") for _ in range(r.randint(7, 11))) for _ in range(n)]
    stems += [s[:k] + r.choice(["", "a", "b", "zz"]) + s[k + 1:] for s in stems for k in (0, 3, 6, len(s) - 1)]
    rows = [(i, " ".join(r.choice([w, w.upper() if w.isascii() else w]) for w in r.choices(stems, k=120))) for i in range(40)]
    often = [(100 + k, " ".join([s] * (50 * 10 ** (k % 2))) + " " + " ".join([s[:-1] + "q"] * 3)) for k, s in enumerate(stems[:8])]
    return rows + often + [(None, stems[0] + " " + stems[0]), (5, rows[5][1]), (200, None), (201, ""), (202, "short 日本語 1234567")]


@pytest.mark.parametrize("block", [1 << 16, 3])
def test_spelling_variants(spark, block):
    """With blocks of three words most groups have several."""
    rows = misspelt(7)
    want = spelled(rows)
    got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_variants(documents(spark, rows), block=block).collect()}
    assert got == want and any(v[0] for v in want.values()) and sum(v[3] for v in want.values()) > 200


def test_roots_follow_chains(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(9)] + [("x", "w4")], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w9"}


def test_spelling_of_an_empty_table(spark):
    assert spelling.spelling_variants(documents(spark, [])).count() == 0
    assert spelling.spelling_variants(documents(spark, [(1, None), (2, "once upon")])).count() == 0


# ------------------------------------------------------------ hard negatives

ROWS = "vec_id long, embedding array<float>, label int, score int, rank int, anchor_id int"


def vectors(seed, n=260, dim=5):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x = (r.integers(-3, 4, dim) / 4).astype(np.float32).tolist()  # many ties
        if i % 17 == 3:
            x = x[:dim - 2]
        out.append((i, x, int(r.integers(0, 3))))
    return out + [(1001, None, 1), (1002, [None, 1.0], 1), (1003, [math.nan], 1), (1004, [math.inf], 1), (1005, [1.0], None),
                  (None, [1.0], 1), (20, out[20][1], out[20][2]), (1100, [], 0), (1101, [1e30, -1e30], 2), (1200, [0.0] * dim, 2)]


def mined(rows, every):
    taken = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        v = tuple(max(-2 ** 24, min(2 ** 24, math.floor(256 * v))) for v in x)
        taken[i] = min(taken.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in taken.items():
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in taken.items() if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [(-t, i) for t, i, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, k + 1, i, -s, t) for k, (t, i) in enumerate(inside[:10])]
    return sorted(out)


@pytest.mark.parametrize("every,block", [(10, 1000), (10, 5), (1, 40)])
def test_hard_negatives(spark, every, block):
    rows = vectors(every + block)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], ROWS)
    got = hard_negatives.hard_negatives(hard_negatives.vectors(df), every, block).collect()
    want = mined(rows, every)
    assert sorted(map(tuple, got)) == want and len(want) > 200


def test_bounds_leave_rows_out(monkeypatch):
    """Along the tree few rows of clustered vectors are scored, and none is missed."""
    r = np.random.default_rng(2)
    centres = r.integers(-400, 400, (6, 16))
    rows = np.concatenate([c + r.integers(-6, 7, (200, 16)) for c in centres])
    anchors = rows[::25]
    tree = hard_negatives.AnchorTree(np.arange(len(anchors)), np.zeros(len(anchors)), anchors)
    assert (tree.parent[1:] >= 0).all() and (tree.parent < np.arange(len(anchors))).all()
    least, scored = {}, 0
    for k in range(len(anchors)):
        least[k] = np.sort(rows @ tree.points[k])[-5]
    for k, some, exact in tree.scored(rows, lambda k, low, high: high >= least[k]):
        scored += len(some)
        assert (exact == rows[some] @ tree.points[k]).all()
        assert set(np.flatnonzero(rows @ tree.points[k] >= least[k])) <= set(some.tolist())
    assert scored < 0.5 * len(rows) * len(anchors)


def test_hard_negatives_of_few_rows(spark):
    def run(rows):
        return hard_negatives.hard_negatives(hard_negatives.vectors(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], ROWS))).collect()
    assert run([]) == [] and run([(1, [1.0], 1)]) == [] and run([(100, [1.0], 1), (1, [1.0], 2)]) == []
    assert [tuple(r) for r in run([(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.25], 2)])] == [(100, 1, 1, 2, 65536, 32768)]
