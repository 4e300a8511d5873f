"""Benchmark windows against brute force, in one block and in several."""

import hashlib
import re

import pytest

from vigil.llm.contamination import find_contamination, remove_contaminated

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog again and again."),
    (10, "Short item"),
    (2, None),
    (3, "..."),
    (4, "Again the QUICK brown fox jumps over the lazy dog, again: and again"),
    (None, "nameless words stand here"),
    (1, "a second text of item one"),
]
DOCS = [
    (0, "nothing of that kind"),
    (1, "we saw the quick-brown FOX jumps over the lazy dog again yesterday"),
    (2, "a short ITEM, and a Short\nitem"),
    (3, None),
    (4, ""),
    (5, "so nameless words stand here; a second text of item one"),
    (6, "long " * 20000 + "short item"),
    (6, "short item"),
]


def words(text):
    lower = (text or "").encode().translate(
        bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    )
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, n=10):
    said, hit, items = words(text), set(), set()
    for item, item_text in ITEMS:
        of_item = words(item_text)
        m = min(n, len(of_item))
        for i in range(len(of_item) - m + 1 if m else 0):
            for at in range(len(said) - m + 1):
                if said[at : at + m] == of_item[i : i + m]:
                    hit.update(range(at, at + m))
                    items.add("" if item is None else str(item))
    joined = ",".join(sorted(items))
    return len(said), len(hit), len(items), hashlib.sha256(joined.encode()).hexdigest()


@pytest.mark.parametrize("block", [2_000_000, 3])
def test_equals_brute_force(spark, block):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = find_contamination(docs, items, n=10, block=block).collect()
    assert len(got) == len(DOCS)
    by_text = {text: brute(text) for _, text in DOCS}
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == by_text[r.text]
        assert r.contaminated == (r.n_hit > 0)


def test_removal_and_defined_cases(spark):
    schema = "doc_id long, text string, n_hit int, lang string"
    docs = spark.createDataFrame([(a, b, 5, None) for a, b in DOCS], schema)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = remove_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]
    cut = remove_contaminated(docs.filter("doc_id = 2"), items, spans=True).collect()
    assert cut[0].text == "a and a"
    no_items = items.limit(0)
    assert find_contamination(docs, no_items).filter("contaminated").isEmpty()
    assert find_contamination(docs.limit(0), items).collect() == []
