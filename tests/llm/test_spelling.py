"""Spelling variants against brute force over all pairs of words, and their defined cases."""

import random
import re
import zlib
from collections import Counter

from vigil.llm import spelling
from vigil.llm.common import Scratch

SCHEMA = "doc_id long, text string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, letters=6, least=5, times=5, one_in=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= letters and n >= least}
    out, forms = {}, {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= times * n else None
        out[word] = (n, len(others), forms[word], counts.get(forms[word]))
    for word in out:
        root = word
        while forms[root] is not None:
            root = forms[root]
        out[word] += (root,)
    return out


def found(spark, rows, **bounds):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = spelling.variants(docs, Scratch(spark), **bounds).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got}


def test_small_alphabet_equals_brute_force(spark):
    """Short words over three letters: runs of equal letters, ties and chains of forms."""
    draw = random.Random(5)
    words = ["".join(draw.choices("aaàb", k=draw.randint(2, 5))) for _ in range(160)]
    words = [w for k, w in enumerate(words) for _ in range(6 ** (k % 4))]
    draw.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    bounds = dict(least_letters=2, least_count=1, one_in=7)
    got = found(spark, rows, **bounds)
    assert got == brute(rows, 2, 1, 5, 7)
    assert any(r[2] is not None and r[4] != r[2] for r in got.values())  # a chain of forms


def test_edits_of_long_words(spark):
    said = "Straßenbahn Straßenbahnn Strasenbahn straßenbaxn STRASSENBAHN straenbahn"
    counted = [w for w, k in zip(said.split(), (150, 25, 5, 5, 30, 6)) for _ in range(k)]
    rows = [(1, ", ".join(counted)), (2, None), (3, ""), (None, "x1y " + "-".join(counted))]
    rows.append(rows[0])
    got = found(spark, rows)
    assert got == brute(rows)
    assert got["straßenbahnn"][2] == "straßenbahn"


def test_whole_texts_and_extra_columns(spark):
    long = " ".join(["haystack"] * 60_000 + ["haystock"] * 5)
    docs = spark.createDataFrame(
        [(1, long, 1, "g")], "doc_id long, text string, n int, gap string"
    )
    got = {r.word: r for r in spelling.variants(docs, Scratch(spark)).collect()}
    assert {w: tuple(r)[1:] for w, r in got.items()} == brute([(1, long)])
    assert got["haystock"].root == "haystack"


def test_empty_table(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, None), (2, "short")]) == {}


def test_rotations_are_linear(spark):
    words = spark.createDataFrame([("aabbcc", 5), ("abcdefgh", 7)], "word string, n long")
    rows = spelling.rotations(words).collect()
    assert len(rows) == 13 + 17
    gaps = sorted(r.gap for r in rows if r.word == "aabbcc" and r.longer)
    assert gaps == sorted(["abbcc$", "bbcc$a", "bcc$aa", "cc$aab", "c$aabb", "$aabbc"])
    assert sum(r.first for r in rows if r.word == "aabbcc") == 3
