"""Sharding, near duplicates, substrings and lines against plain versions."""

import hashlib
import time
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from rollcall.llm import lines, near_text, sharding, substrings

from .conftest import CLASHING, ODD_ROWS


def digest(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def plain_table(names, slots):
    """Shards claim slots in turns, one by one."""
    first = [digest("offset " + n) % slots for n in names]
    by = [digest("step " + n) % (slots - 1) + 1 for n in names]
    at, table, claimed = [0] * len(names), [None] * slots, 0
    while True:
        for k, name in enumerate(names):
            while table[slot := (first[k] + at[k] * by[k]) % slots] is not None:
                at[k] += 1
            table[slot] = name
            claimed += 1
            if claimed == slots:
                return table


@pytest.mark.parametrize(("shards", "slots"), [(1, 2), (3, 13), (7, 701), (13, 13)])
def test_lookup_table(spark, shards, slots):
    names = [f"s{k}" for k in range(shards)]
    found = {r["slot"]: r["shard"] for r in sharding.lookup_table(spark, names, slots).collect()}
    want = plain_table(names, slots)
    assert found == dict(enumerate(want))
    assert max(Counter(want).values()) - min(Counter(want).values()) <= 1


def test_a_lost_shard_moves_few_keys(spark):
    names = [f"s{k}" for k in range(8)]
    before, after = plain_table(names, 2003), plain_table(names[:-1], 2003)
    assert sum(a != b for a, b in zip(before, after) if a != "s7") < 0.1 * 2003


@pytest.mark.parametrize(("names", "slots"), [(["a", "a"], 13), ([], 13), (["a"], 12), (["a"], 65_539), (["a", "b", "c"], 2)])
def test_bad_tables_are_refused(spark, names, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, names, slots)


def test_shards_of_odd_rows(spark, odd_docs, no_docs, tmp_path):
    names = ["x", "y", "z"]
    table = plain_table(names, 31)
    found = sharding.shard(odd_docs, "doc_id", names, 31)
    assert "Python" not in found._jdf.queryExecution().toString() and "slot" in found.columns and "Slot" not in found.columns
    rows = found.select("doc_id", "slot", "shard").collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD_ROWS)
    for r in rows:
        assert r["slot"] == digest("" if r["doc_id"] is None else str(r["doc_id"])) % 31 and r["shard"] == table[r["slot"]]
    assert sharding.op1_sharding(no_docs, 3, 31).collect() == []
    sharding.write_shards(odd_docs.select("doc_id", "text"), "doc_id", names, str(tmp_path / "out"), 31)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ODD_ROWS)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def plain_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    ids = {}
    for k, (doc, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(doc)
    low = {r: min((d for d in some if d is not None), default=None) for r, some in ids.items()}
    return Counter((doc, len(sets[k]), low[find(k)], doc == low[find(k)]) for k, (doc, _) in enumerate(rows))


def near_rows():
    """A text with copies that drift word by word, so that links form chains and a tight group."""
    base = [f"word{k}" for k in range(120)]
    rows, words = [], list(base)
    for k in range(25):
        words[(k * 37) % 120] = f"new{k}"
        rows.append((1000 - k, " ".join(words)))
    for k in range(25):
        own = list(base)
        own[(k * 11) % 120] = f"own{k}"
        own[(k * 29 + 5) % 120] = f"more{k % 4}"
        rows.append((2000 + k, " ".join(own)))
    return rows


def test_near_duplicates(make_docs):
    rows = near_rows()
    found = near_text.op2_minhash_near_dedup(make_docs([(*r, "a") for r in rows])).collect()
    assert Counter(map(tuple, found)) == plain_components(rows)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = near_text.op2_minhash_near_dedup(odd_docs).collect()
    assert Counter(map(tuple, found)) == plain_components([(r[0], r[1]) for r in ODD_ROWS])
    assert near_text.op2_minhash_near_dedup(no_docs).collect() == []


def test_pages_of_one_template_below_the_threshold_make_few_pairs(spark, make_docs, monkeypatch):
    """Pages that share a template and, in pairs of neighbours, more: only the neighbours are compared, and linked."""
    template = [f"t{k}" for k in range(240)]
    rows = []
    for k in range(1200):
        own = [f"p{k}w{j}" for j in range(70)] if k % 100 else [f"q{k // 200}w{j}" for j in range(70)]
        rows.append((k, " ".join(template + [f"pool{(k * j) % 211}x{j % 3}" for j in range(8)] + own)))
    seen = []
    compared = near_text.confirmed
    monkeypatch.setattr(near_text, "confirmed", lambda pairs, *more: seen.append(pairs.count()) or compared(pairs, *more))
    found = {r["doc_id"]: r["component_id"] for r in near_text.op2_minhash_near_dedup(make_docs([(*r, "a") for r in rows])).collect()}
    sets = {k: shingle_set(t) for k, t in rows if k % 100 == 0}
    for a, b in combinations(sets, 2):
        linked = 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
        assert linked == (a // 200 == b // 200)
    assert all(found[k] == (k // 200 * 200 if k % 100 == 0 else k) for k in found)
    assert seen[1] < 20 * len(rows)


def test_a_very_long_text_is_sketched_in_parts(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (30_000, 7, 500)]
    want = near_text.sketches(sets)
    monkeypatch.setattr(near_text, "TOGETHER", 1000)
    assert (near_text.sketches(sets) == want).all()


def test_bands_and_signatures_follow_the_threshold():
    assert near_text.banding(85) == (36, 7) and near_text.agreeing(85) == 214
    for percent in (10, 50, 80, 99, 100):
        bands, rows = near_text.banding(percent)
        assert bands * rows <= near_text.COORDINATES and (1 - (percent / 100) ** rows) ** bands <= 1e-6
    assert 203 <= near_text.agreeing(80) <= 205
    with pytest.raises(ValueError):
        near_text.banding(1)


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    common, own = rng.integers(0, 1 << 63, 400, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, own[:100]])), np.unique(np.concatenate([common, own[100:]])), common[:1]]
    sketch = near_text.sketches(sets, 1024)
    assert (sketch != near_text._MAX).all()
    assert abs((sketch[0] == sketch[1]).mean() - 400 / 600) < 0.07
    assert (near_text.sketches([sets[1]], 1024)[0] == sketch[1]).all()


def plain_substrings(rows, width):
    texts = [(t or "").encode().split() for _, t in rows]
    counts = Counter(tuple(w[k : k + width]) for w in texts for k in range(len(w) - width + 1))
    out = []
    for (doc, _), words in zip(rows, texts):
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if counts[tuple(words[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("width", "first", "chunk"), [(35, 18, 1_000_000), (35, 5, 100), (7, 2, 1), (4, 4, 30), (9, 20, 50)])
def test_substrings(make_docs, monkeypatch, width, first, chunk):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    rows = [(k, " ".join(f"t{(k * j) % 7}" for j in range(k * 3))) for k in range(30)] + [(r[0], r[1]) for r in ODD_ROWS]
    found = substrings.substring_dedup(make_docs([(*r, "a") for r in rows]), width, first).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == plain_substrings(rows, width)


def test_levels_double_until_the_width():
    assert substrings.levels(35, 18) == [18, 35] and substrings.levels(35, 5) == [5, 10, 20, 35] and substrings.levels(4, 9) == [4]


def test_substrings_of_nothing(no_docs):
    assert substrings.op7_substring_dedup(no_docs).collect() == []


def plain_lines(rows, run):
    """Rows that repeat id and text are one document; null ids come first, texts of one id in the order in which Spark finds them."""
    texts = {(doc, text): [line for line in (text or "").split("\n") if line.strip()] for doc, text in rows}
    order = sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, mark_of(t[1])))
    seen, gone = set(), {}
    for key in order:
        own = texts[key]
        gone[key] = set()
        for k in range(len(own) - run + 1):
            if tuple(own[k : k + run]) in seen:
                gone[key].update(range(k, k + run))
            seen.add(tuple(own[k : k + run]))
    out = []
    for doc, text in rows:
        own, cut = texts[doc, text], gone[doc, text]
        kept, at = [], 0
        for line in (text or "").split("\n"):
            if line.strip():
                if at not in cut:
                    kept.append(line)
                at += 1
            else:
                kept.append(line)
        final = None if text is None else text if not cut else "" if len(cut) == len(own) else "\n".join(kept)
        out.append((doc, len(own), len(cut), final))
    return Counter(out)


def mark_of(text):
    """The mark that orders texts of one id: XXH64 with Spark's seed, as a signed number."""
    n = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return n - (1 << 64) if n >> 63 else n


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_lines(make_docs, run):
    rows = [(k, "\n".join(f"line {(k * j) % 5}" if j % 4 else "" for j in range(k))) for k in range(25)]
    rows += [(r[0], r[1]) for r in ODD_ROWS]
    found = lines.line_dedup(make_docs([(*r, "a") for r in rows]), run).select("doc_id", "n_lines", "n_removed", "text")
    assert Counter(map(tuple, found.collect())) == plain_lines(rows, run)


def test_a_line_goes_whatever_stands_beside_it(make_docs):
    rows = [(1, "a\nshared\nb"), (2, "c\nshared\nd"), (3, "shared"), (4, "e\nshared")]
    found = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.line_dedup(make_docs([(*r, "a") for r in rows])).collect()}
    assert found == {1: ("a\nshared\nb", 0), 2: ("c\nd", 1), 3: ("", 1), 4: ("e", 1)}


def test_fingerprints_are_fewer_than_windows_and_cover_each_of_them(make_docs):
    rows = [(k, "\n".join(f"l{(k * j * j) % 97}" for j in range(60))) for k in range(1, 20)]
    found = lines.fingerprints(make_docs([(*r, "a") for r in rows]), 8).groupBy("doc_id").agg({"place": "collect_list"}).collect()
    for doc, places in found:
        assert len(places) < 30 and len(set(places)) == len(places)
        assert all(any(s <= p < s + 8 for p in places) for s in range(53))


def test_production_matches_by_thinned_fingerprints_and_checks_the_rest(make_docs):
    copied = "\n".join(f"l{k}" for k in range(60))
    docs = make_docs([(1, copied, "a"), (2, f"own\n\n{copied}", "a"), (3, "other\nl7\nmore", "a")])
    assert lines.fingerprints(docs).count() < 0.6 * 124  # not every line is one
    matched = lines._matched(docs, lines.WINDOW).select("doc_id", "at").distinct().collect()
    assert sorted(map(tuple, matched)) == [(2, at) for at in range(2, 62)]
    alone = lines._later_alone(docs, lines._matched(docs, lines.WINDOW)).select("doc_id", "at").collect()
    assert list(map(tuple, alone)) == [(3, 1)]


def test_a_text_of_very_many_lines(make_docs):
    """Every third line goes; twice the lines take about twice the time."""
    took = {}
    for n in (2_000, 32_000, 64_000):
        rows = [(1, "\n".join(f"x{k}" for k in range(0, n, 3)), "a"), (2, "\n".join(f"x{k}" for k in range(n)), "a")]
        started = time.perf_counter()
        removed = {r["doc_id"]: r["n_removed"] for r in lines.line_dedup(make_docs(rows)).collect()}
        took[n] = time.perf_counter() - started
        assert removed == {1: 0, 2: len(range(0, n, 3))}
    assert took[64_000] < 3 * took[32_000] + 2


def test_lines_of_odd_rows(odd_docs, no_docs):
    found = lines.line_dedup(odd_docs)
    assert "Python" not in found._jdf.queryExecution().toString()
    assert {c for c in CLASHING if c not in ("text_mark", "n_lines")} <= set(found.columns)
    rows = found.select("doc_id", "text", "n_lines", "n_removed").collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD_ROWS)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["text"] is None and by_id[1]["n_lines"] == 0
    assert by_id[12]["text"] == "other\n" and by_id[12]["n_removed"] == 2
    assert by_id[13]["text"] == "" and by_id[13]["n_lines"] == by_id[13]["n_removed"] == 3  # its last line stands in 11 too
    assert lines.op9_line_dedup(no_docs).collect() == []
