"""Line dedup and decontamination against brute force."""

import re
from collections import Counter, defaultdict

from rows import DOCS, PASSAGE, docs_table

from clientela.llm import decontaminate, line_dedup

BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_lines(docs, least=40, many=5):
    holders = defaultdict(set)
    for key, text in docs:
        for line in (text or "").split("\n"):
            k = ascii_lower(line.strip(BLANK))
            if len(k) >= least:
                holders[k].add(key)
    out = []
    for key, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            own = holders.get(ascii_lower(line.strip(BLANK)), set())
            last = max(own, key=lambda x: (x is not None, x or 0)) if own else None
            if len(own) < many or key == last:
                kept.append(line)
        out.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def test_lines_match_brute_force(spark):
    got = line_dedup.drop_shared_lines(docs_table(spark)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert Counter(tuple(r) for r in got) == brute_lines(DOCS)
    assert sum(r["n_dropped"] for r in got) > 4


def test_lines_keep_other_columns_and_empty_tables(spark):
    found = line_dedup.drop_shared_lines(docs_table(spark, []))
    assert found.count() == 0
    assert set(docs_table(spark).columns) <= set(found.columns)


def test_short_and_rare_lines_stay(spark):
    rows = [(i, "short line\n" + "only four documents hold this rather long line" * (i < 4)) for i in range(9)]
    got = line_dedup.drop_shared_lines(docs_table(spark, rows))
    assert {r["n_dropped"] for r in got.collect()} == {0}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def brute_windows(docs, items, size=10):
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(size, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1 if windows else 0):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add("null" if item is None else str(item))
        out.append((key, len(w), len(hit), ",".join(sorted(found)), bool(hit)))
    return Counter(out)


ITEMS = [(1, PASSAGE), (2, "short one"), (3, None), (4, ""), (10, PASSAGE + " and more words that stand nowhere else at all"), (None, "ß"), (5, "..."), (5, "alpha0 bravo")]


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_windows_match_brute_force(spark):
    got = decontaminate.find_contamination(docs_table(spark), item_table(spark, ITEMS)).collect()
    rows = Counter((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"]), r["contaminated"]) for r in got)
    assert rows == brute_windows(DOCS, ITEMS)
    assert max(r["n_hit"] for r in got) >= 12


def test_windows_without_items_or_documents(spark):
    none = decontaminate.find_contamination(docs_table(spark), item_table(spark, []))
    assert {r["contaminated"] for r in none.collect()} == {False}
    assert decontaminate.find_contamination(docs_table(spark, []), item_table(spark, ITEMS)).count() == 0


def test_drop_contaminated_keeps_columns_and_clean_rows(spark):
    docs = docs_table(spark)
    kept = decontaminate.drop_contaminated(docs, item_table(spark, ITEMS[:1]))
    assert kept.columns == docs.columns
    bad = {k for (k, *_, hit), _ in brute_windows(DOCS, ITEMS[:1]).items() if hit}
    assert bad == {10, 11}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(k for k, _ in DOCS if k not in bad)


def test_word_filter_never_misses():
    import numpy as np
    import xxhash

    bits = np.zeros(decontaminate.FILTER_SLOTS // 8, np.uint8)
    wanted = [b"alpha", "ß".encode(), b"zz9"]
    for w in wanted:
        slot = xxhash.xxh64_intdigest(w, 42) % decontaminate.FILTER_SLOTS
        bits[slot // 8] |= 1 << slot % 8
    keep = decontaminate.WordFilter(bits.tobytes())
    assert keep.passes([b"x", b"alpha", b"zz9", b"y", "ß".encode()]) == [1, 2, 4]
