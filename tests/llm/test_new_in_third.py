"""Spelling variants, Merkle manifest, chunk recipes against plain versions of their rules."""
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle, recipes, variants

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = "digests raw_hash text_sha256 chunks _row group id leaf claim rank depth node block word n above proof child root size".split()


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lower(s):
    return (s or "").encode().lower().decode()


# ---- chunk recipes -----------------------------------------------------------------------------


def plain_copies(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(lower(text), []).append(doc)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            out[i, keep, len(ids), i == keep and first, h(text)] += 1
            first = first and i != keep
    return out


def noise(rng, n):
    return "".join(rng.choice("abcdefgh é\nXYZ") for _ in range(n))


@pytest.mark.parametrize("width", [8, 1])
def test_copies_equal_plain_grouping(spark, width):
    """With digests of one byte nearly all chunks clash, so lists agree only through the verified numbers."""
    rng = random.Random(3)
    base = [noise(rng, n) for n in (1, 40, 300, 300, 300, 301, 5000, 40000, 9000)] + ["x" * 30000, "x" * 30001, "", None, "Zz", "zZ", "ÀB", "àb"]
    rows = [(i, rng.choice(base)) for i in range(300)] + [(None, base[3]), (None, None), (7, base[6]), (7, base[6])]
    rows += [(1000 + i, base[7][:20000] + noise(rng, 3) + base[7][20000:]) for i in range(20)] + [(2000 + i, noise(rng, 200)) for i in range(200)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS).withColumns({c: F.lit("x") for c in CLASH}).repartition(5)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in recipes.exact_copies(df, digest_bytes=width).collect())
    want = plain_copies(rows)
    assert {(*k[:3], k[4]) for k in got} == {(*k[:3], k[4]) for k in want}
    for k, n in want.items():
        if k[0] is not None:
            assert got[k] == n, k


def test_one_row_of_a_group_stays(spark):
    rows = [(None, "a"), (None, "A"), (3, "b"), (3, "B"), (3, "b"), (1, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = [(r.doc_id, r.group_size) for r in recipes.exact_copies(df).collect() if r.kept]
    assert sorted(kept, key=str) == [(3, 4), (None, 2)]
    assert recipes.exact_copies(df.limit(0)).count() == 0


def test_chunks_depend_on_content_alone():
    rng = random.Random(5)
    raw = noise(rng, 60000).encode()
    ends = recipes.chunk_ends(raw)
    sizes = [b - a for a, b in zip([0, *ends], ends, strict=False)]
    assert ends[-1] == len(raw) and min(sizes[:-1]) >= recipes.LEAST and max(sizes) <= recipes.MOST
    shifted = recipes.chunk_ends(b"some words in front " + raw)
    assert len({raw[a:b] for a, b in zip([0, *ends], ends, strict=False)} &
               {(b"some words in front " + raw)[a:b] for a, b in zip([0, *shifted], shifted, strict=False)}) >= len(ends) - 3
    assert recipes.chunk_ends(b"") == [] and recipes.chunk_ends(b"a") == [1]
    long = bytes(rng.randrange(256) for _ in range(recipes.BLOCK + 5000))
    whole = recipes.cut_places(long)
    assert [p for p in whole if p > recipes.BLOCK + 40] == [p + recipes.BLOCK for p in recipes.cut_places(long[recipes.BLOCK:]) if p > 40]


# ---- Merkle manifest ---------------------------------------------------------------------------


def plain_leaf(row, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 3 * 3
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 3])))
        at //= 3
    return out


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
    trees = [plain_tree([plain_leaf(r, r[1]) for r in by[s]]) for s in names]
    top = plain_tree([t[-1][0] for t in trees])
    out = Counter()
    for g, s in enumerate(names):
        for at, r in enumerate(by[s]):
            path = plain_path(trees[g], at) + plain_path(top, g)
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = plain_leaf(r, text)
            for a, b in path:
                now = h(a + now + b)
            out[r[0], plain_leaf(r, r[1]), trees[g][-1][0], top[-1][0], h("".join(a + b for a, b in path)), now, now == top[-1][0]] += 1
    return out


def of_manifest(df):
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest_equals_plain_trees(spark):
    """Sources of 0 to 7 levels (one beyond a block), ties, repeated rows, nulls in every column, many sources."""
    rng = random.Random(7)
    sizes = {"one": 1, "two": 2, "three": 3, "four": 4, "nine": 9, "ten": 10, "": 28, "é": 82, None: 5, "block": 729, "more": 731, **{f"s{i}": 1 for i in range(20)}}
    rows, n = [], 0
    for s, k in sizes.items():
        for _ in range(k):
            n += 1
            rows.append((n, rng.choice(["a\nb", "plain", "", None, "é\n\n", "x" * 100]), rng.choice(["en", None]), s, rng.choice([3, None])))
    rows += [(5, "a\nb", "en", "four", 3), (5, "a\nb", "en", "four", 3), (None, "t\n", None, "ten", None), (None, None, None, None, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("x") for c in CLASH}).repartition(4)
    assert of_manifest(merkle.manifest(df, merkle.without_line_feeds())) == plain_manifest(rows)


def test_manifest_of_small_tables(spark):
    nothing = spark.createDataFrame([], COLUMNS)
    assert merkle.manifest(nothing, merkle.without_line_feeds()).count() == 0
    row = (1, "long\n" * 100000, "en", "s", 4)
    got = merkle.manifest(spark.createDataFrame([row], COLUMNS)).collect()
    leaf = plain_leaf(row, row[1])
    assert [tuple(r) for r in got] == [(1, leaf, leaf, leaf, h(""), leaf, True)]


# ---- spelling variants -------------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def plain_groups(counts):
    out = {}
    for w, n in counts.items():
        by = sorted(((-m, o) for o, m in counts.items() if near(w, o)))
        form = by[0][1] if by and -by[0][0] >= 5 * n else None
        out[w] = (n, len(by), form, counts[form] if form else None)
    rows = set()
    for w, (n, k, form, form_n) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.add((w, n, k, form, form_n, root))
    return rows


def of_groups(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_groups_equal_plain_comparison(spark):
    """Random words over few letters, so that leaves and edits are dense; the trie is cut into many small nodes."""
    rng = random.Random(11)
    words = {"".join(rng.choice("aetéüxyz") for _ in range(rng.randint(6, 8))) for _ in range(400)}
    for w in list(words)[:200]:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + rng.choice("aeté") + w[i:], w[:i] + rng.choice("aeté") + w[i + 1:]}
    words |= {"e" * 300, "e" * 301, "e" * 150 + "t" + "e" * 150, "listen", "silent", "enlist"}
    counts = {w: 5 ** rng.randint(0, 7) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    want = plain_groups(counts)
    assert of_groups(variants.group_words(df, most=20)) == want == of_groups(variants.group_words(df))
    assert any(r[5] not in (r[0], r[3]) for r in want)  # a chain of two links at least


def test_words_are_read_as_stated(spark):
    text = "Coffee coffee COFFEE naïveté ÀÉÎÕÜü short coffee×time it's, " * 3 + "z" * 50000
    rows = [(i, text if i % 3 else text.upper()) for i in range(400)] + [(None, text), (None, None), (5, ""), (6, None)]
    want = Counter()
    for doc, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", lower(t)):
            c = zlib.crc32(f"{doc}:{w}".encode())
            if doc is not None and c % 199 == 0:
                w = w[:c % len(w)] + w[c % len(w) + 1:]
            if len(w) >= 6:
                want[w] += 1
    want = {w: n for w, n in want.items() if n >= 5}
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("word", "n", "id", "node")}).repartition(3)
    got = variants.spelling_variants(df)
    assert {r.word: r.n for r in got.collect()} == want
    assert of_groups(got) == plain_groups(want)
    assert variants.spelling_variants(df.limit(0)).count() == 0
