"""Exact dedup, SimHash, previous factors and passages against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lendlens.llm import block_naming, graph, passages, queries, seeds, simhash, suffixes
from lendlens.llm.common import FILE_ROWS, LEAST_FILES, stored
from tests.llm.conftest import ODD, SF_DIR, frame


def by_id(rows):
    return {row["doc_id"]: row for row in rows}


def test_exact_groups_of_odd_rows(odd, none):
    rows = block_naming.exact_groups(odd, block_chars=4).collect()
    assert len(rows) == len(ODD)
    assert {r.keep_id for r in rows if r.doc_id in (7, 9)} == {9}
    assert {r.keep_id for r in rows if r.doc_id in (3, 5)} == {5}
    assert sorted(r.group_size for r in rows) == [1, 1, 1, 2, 2, 3, 3, 3]
    assert sum(r.kept for r in rows) == 5
    assert block_naming.exact_groups(none).collect() == []


def test_hash_collisions_do_not_merge_texts(spark):
    texts = [(i, f"{i % 7} some text {i % 7} with blocks") for i in range(40)]
    rows = block_naming.exact_groups(
        frame(spark, texts), block_chars=5, block_hash=lambda block: F.xxhash64(block) % 3
    ).collect()
    assert all(r.keep_id == max(i for i, _ in texts if i % 7 == r.doc_id % 7) for r in rows)


def test_drop_copies_keeps_columns_and_one_row(spark, odd):
    kept = block_naming.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 5, 9, 11, 12]


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    many = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    shingles = many or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if label[j] < label[i] and (prints[i] ^ prints[j]).bit_count() <= radius:
                    label[i], changed = label[j], True
    return label


def test_near_groups_equal_brute_force(spark, documents):
    docs = documents[:60] + [(1000 + i, t.replace("the", "tha", 1)) for i, t in documents[:40]]
    docs += [(2000, None), (2001, ""), (2002, "one two"), (2003, "A b C")]
    rows = by_id(simhash.near_groups(frame(spark, docs), tile=16).collect())
    prints = {i: brute_fingerprint(t) for i, t in docs}
    assert {i: int(r.fingerprint, 16) for i, r in rows.items()} == prints
    assert {i: r.component_id for i, r in rows.items()} == brute_components(prints)


def test_near_groups_of_odd_rows(odd, none):
    assert len(simhash.near_groups(odd).collect()) == len(ODD)
    assert simhash.near_groups(none).collect() == []


def test_tile_links_join_a_large_group_without_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, dtype=np.uint64)
    near = np.unique([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 62, 400)])
    far = rng.integers(0, 2**63, 500, dtype=np.uint64)
    prints = np.unique(np.concatenate([near, far]))
    links = simhash.tile_links(prints, prints, True, 3)
    assert len(links) == len(near) - 1
    half = len(prints) // 2
    across = simhash.tile_links(prints[:half], prints[half:], False, 3)
    assert all((a ^ b).bit_count() <= 3 for a, b in across)


@pytest.mark.parametrize("n", [1, 40])
def test_components_of_chain_and_star(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(100, 100 + i) for i in range(n)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found if r.node <= n} == {i: 0 for i in range(n + 1)}


def test_small_tables_have_few_files(spark):
    """Each file costs two processes on a local file system; a shuffle may have many partitions."""
    wide = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in wide}
    for key, value in wide.items():
        spark.conf.set(key, value)
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(0, 3000, 2)], "a long, b long")
        found = graph.components(edges)
        assert found.count() == 3000
        assert len(found.inputFiles()) <= LEAST_FILES
        many = stored(edges.distinct(), "many", 20 * FILE_ROWS)
        assert many.count() == 1500 and LEAST_FILES < len(many.inputFiles()) <= 20
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def brute_removed(docs, span=50):
    first, result = {}, {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - span + 1):
            window = data[i : i + span]
            if first.setdefault(window, doc_id) < doc_id:
                gone[i : i + span] = True
        result[doc_id] = np.frombuffer(data, np.uint8)[~gone].tobytes()
    return result


def test_previous_factors_equal_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)  # texts in several pieces
    line = "a line that very many documents have in common, of over fifty bytes."
    docs = documents[:60] + [(500 + i, f"{i} {line} {i * 7919}") for i in range(30)]
    docs += [(900, None), (901, ""), (902, "ab" * 80), (903, "ab" * 90), (904, documents[3][1])]
    rows = by_id(suffixes.remove_repeats(frame(spark, docs)).collect())
    assert {i: bytes(r.kept) for i, r in rows.items()} == brute_removed(docs)
    for i, row in rows.items():
        assert row.n_removed == sum(e - s for s, e in zip(row.starts, row.ends))


def test_previous_factors_of_odd_rows(odd, none):
    rows = suffixes.remove_repeats(odd).collect()
    assert len(rows) == len(ODD)
    assert sum(r.n_removed for r in rows) == 0
    assert suffixes.remove_repeats(none).collect() == []


def test_runs_are_matched_bucket_by_bucket():
    line, read, rows = "the same words in every one of these texts " * 4, [], []
    for first in (0, 50):  # two batches, the second one with other beginnings
        docs = [[*range(first, first + 20)], [f"{i * 7919} {line}{i}" for i in range(first, first + 20)]]
        rows += suffixes._seed_rows(3)([pa.RecordBatch.from_pydict({"rank": docs[0], "text": docs[1]})])
    rows.sort(key=lambda batch: batch.column(0)[0].as_py())

    def one_by_one():
        for batch in rows:
            read.extend(batch.filter(batch.column(1).is_valid()).column(0).to_pylist())
            yield batch

    def matched(batches):
        return {row for batch in suffixes._match_runs(batches) for row in zip(*(c.to_pylist() for c in batch.columns))}

    read_before = []
    for batch in suffixes._match_runs(one_by_one()):
        if suffixes.REQUEST in batch.column(0).to_pylist():
            read_before.append(set(read))
    assert set(read) == {0, 1, 2} and len(read_before[0]) < 3  # not all buckets are held at once
    by_bucket = [[b for b in rows if b.column(0)[0].as_py() == bucket] for bucket in range(3)]
    assert matched(rows) == set().union(*map(matched, by_bucket))


def test_factor_array():
    #  suffix order: documents 2 1 3 1, neighbours share 5 7 2
    assert suffixes.previous_factors([2, 1, 3, 1], [0, 5, 7, 2]).tolist() == [5, 0, 7, 0]


def test_merged_ranges_do_not_cross_texts():
    rank = np.array([1, 1, 1, 2])
    start = np.array([0, 5, (3 << 32) + 2, 4])
    assert seeds.merged(rank, start, start + 5).tolist() == [
        [1, 0, 10],
        [1, (3 << 32) + 2, (3 << 32) + 7],
        [2, 4, 9],
    ]


def test_fuzzy_passages_are_found(spark):
    rng = np.random.default_rng(3)

    def words(n):
        return [f"w{k}" for k in rng.integers(0, 10**6, n)]

    passage, docs = words(120), []
    for i in range(20):
        own = list(passage)
        for at in rng.choice(120, 6 * (i > 0), replace=False):
            own[at] = f"edit{i}x{at}"
        docs.append((i, " ".join(words(80) + own + words(40))))
    docs += [(100 + i, " ".join(words(200))) for i in range(20)]
    docs += [(200, None), (201, ""), (202, "a b c")]
    rows = passages.find_passages(frame(spark, docs)).collect()
    assert {r.doc_id for r in rows} == set(range(1, 20))
    covered = {}
    for r in rows:
        assert r.ref_doc_id < r.doc_id and r.identity >= 0.8
        assert 75 <= r.start_word and r.end_word <= 205
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert all(len(places) >= 72 for places in covered.values())  # 120 words, in part elsewhere
    twice = passages.find_passages(frame(spark, docs + docs)).collect()
    assert {r.doc_id for r in twice} == set(range(1, 20))


def test_passages_with_even_edits_are_found(spark):
    rng = np.random.default_rng(5)
    docs, wanted = [], set()
    for every in (10, 8, 7):
        for k in range(40):
            i = every * 1000 + 2 * k
            own = [f"p{w}" for w in rng.integers(0, 10**6, 60)]
            edited = [f"e{i}x{n}" if n % every == every - 1 else w for n, w in enumerate(own)]
            around = [" ".join(f"f{w}" for w in rng.integers(0, 10**6, 40)) for _ in range(4)]
            docs += [(i, " ".join([around[0], *own, around[1]])), (i + 1, " ".join([around[2], *edited, around[3]]))]
            wanted.add((i + 1, i))
    rows = passages.find_passages(frame(spark, docs)).collect()
    assert {(r.doc_id, r.ref_doc_id) for r in rows} == wanted


def brute_repeats(docs, span=50):
    """Words of a document that stand in an exact repeat of ``span`` words of an earlier one."""
    seen, result = {}, {}
    for doc_id, text in sorted(docs):
        words = text.split()
        windows = [tuple(words[i : i + span]) for i in range(len(words) - span + 1)]
        for i, window in enumerate(windows):
            if seen.setdefault(window, doc_id) < doc_id:
                result.setdefault(doc_id, set()).update(range(i, i + span))
    return result


PARTS = {
    60: [(0, 30), (25, 60)],
    61: [(0, 30), (25, 61), (0, 31), (26, 61)],
    62: [(0, 49), (13, 62), (5, 50)],
    90: [(0, 40), (30, 70), (60, 90), (0, 30), (25, 60), (50, 90)],
}


@pytest.mark.parametrize("length", PARTS)
def test_passages_whose_seeds_have_several_owners(spark, length):
    """No earlier document has enough of the passage; two later ones have it whole."""
    rng = np.random.default_rng(length)

    def words(n):
        return [f"w{w}" for w in rng.integers(0, 10**6, n)]

    passage = words(length)
    docs = [(i, " ".join(words(30) + passage[a:b] + words(30))) for i, (a, b) in enumerate(PARTS[length])]
    docs += [(i, " ".join(words(30) + passage + words(30))) for i in (10, 11, 12)]
    wanted = brute_repeats(docs)
    assert set(wanted) == {11, 12}
    found = {}
    for r in passages.find_passages(frame(spark, docs)).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert {i: places <= found.get(i, set()) for i, places in wanted.items()} == dict.fromkeys(wanted, True)


def test_passages_with_changed_words_are_found(spark):
    """A word changed in every n, from identity 0.83 up, in pairs and in threes."""
    rng = np.random.default_rng(8)
    docs, wanted = [], []
    for every in (6, 7, 8, 10, 12, 20):
        for copy in range(20):
            passage = [f"w{w}" for w in rng.integers(0, 10**6, 80)]
            first = len(docs) * 10
            docs.append((first, " ".join([f"a{first}"] * 20 + passage)))
            for late in range(1, 2 + copy % 2):
                changed = [f"x{w}" if i % every == every - 1 else w for i, w in enumerate(passage)]
                docs.append((first + late, " ".join(changed + [f"b{first}{late}"] * 20)))
                wanted.append(first + late)
    found = {r.doc_id for r in passages.find_passages(frame(spark, docs)).collect()}
    assert len(found & set(wanted)) >= 0.95 * len(wanted) and found <= set(wanted)


def test_no_pair_of_passages_is_left_out(spark):
    """Two unlike versions do not take each other's place; 40 of 50 words suffice wherever the edits are."""
    rng = np.random.default_rng(9)

    def words(n):
        return [f"w{w}" for w in rng.integers(0, 10**6, n)]

    base, around = words(60), lambda own: " ".join(words(30) + own + words(30))
    left = [f"l{i}" if i % 12 in (0, 6) else w for i, w in enumerate(base)]
    right = [f"r{i}" if i % 12 in (3, 9) else w for i, w in enumerate(base)]
    fifth = words(50)
    late = words(50)
    docs = [(1, around(left)), (2, around(right)), (3, around(base)), (4, around(fifth)), (6, around(late))]
    docs.append((5, around([f"e{i}" if i % 5 == 4 else w for i, w in enumerate(fifth)])))
    docs.append((7, around([f"e{i}" if i < 40 and i % 4 == 0 else w for i, w in enumerate(late)])))
    docs.append((8, docs[2][1]))
    found = {(r.doc_id, r.ref_doc_id) for r in passages.find_passages(frame(spark, docs)).collect()}
    assert found == {(3, 1), (3, 2), (5, 4), (7, 6), (8, 3)}


def test_rounds_go_on_until_no_seed_has_a_further_document(spark, monkeypatch):
    """The pair is the last of owners of its halves, and the rounds before find nothing."""
    monkeypatch.setattr(passages, "OWNERS", 2)
    rng = np.random.default_rng(10)

    def words(n):
        return [f"w{w}" for w in rng.integers(0, 10**6, n)]

    passage = words(60)
    halves = [passage[:30], passage[26:]]
    docs = [(i, " ".join(words(30) + halves[i % 2] + words(30))) for i in range(24)]
    edited = [f"e{i}" if i % 15 == 7 else w for i, w in enumerate(passage)]
    docs += [(100, " ".join(words(30) + passage + words(30))), (101, " ".join(words(30) + edited + words(30)))]
    found = {(r.doc_id, r.ref_doc_id) for r in passages.find_passages(frame(spark, docs)).collect()}
    assert found == {(101, 100)}


def test_shares_of_a_round_hold_all_its_matches():
    chance = np.random.default_rng(3)
    seed, rank, place = (chance.integers(0, n, 4000).astype(np.uint64) for n in (5, 300, 1 << 33))
    order = np.lexsort((place, rank, seed))
    opened = (chance.random(4000) < 0.5).astype(np.uint8)
    body = passages.pack(*(column[order] for column in (seed, rank, place)), opened)
    rows = [pa.RecordBatch.from_pydict({"bucket": [0], "kind": [passages.GROUP], "body": [body]})]

    def matches(turns, *share):
        found = [batch.to_pylist() for batch in passages._later_matches(turns, *share)(rows)]
        return [tuple(row.values()) for batch in found for row in batch]

    for turns in (range(1, 5), range(5, 21), range(200, 500)):
        whole, parts = matches(turns), [matches(turns, share, 3) for share in range(3)]
        assert whole and sorted(whole) == sorted(sum(parts, []))
        assert max(map(len, parts)) < len(whole) / 2
        assert len({row[0] for row in whole}) == sum(len({row[0] for row in part}) for part in parts)
        numbers = [n for batch in passages._match_numbers(turns)(rows) for n in batch.column(0).to_pylist()]
        assert sum(numbers) == len(whole)


def test_all_pairs_of_a_passage_with_many_owners_are_found(spark):
    """More owners than ``OWNERS``, so no seed of the passage is rare; each has other words changed."""
    rng = np.random.default_rng(14)
    n = 2 * passages.OWNERS

    def words(n):
        return [f"w{w}" for w in rng.integers(0, 10**6, n)]

    base, docs = words(70), []
    for i in range(n):
        own = list(base)
        for at in rng.choice(70, 3, replace=False):
            own[at] = f"e{i}x{at}"
        if i % 3 == 2:
            del own[35]
        docs.append((i, " ".join(words(20 + i % 5) + own + words(20))))
    line = words(13)
    docs += [(1000 + i, " ".join(words(40) + line + words(40))) for i in range(n)]
    found = {(r.doc_id, r.ref_doc_id) for r in passages.find_passages(frame(spark, docs)).collect()}
    assert found == {(i, j) for i in range(n) for j in range(i)}


def test_frequent_and_rare_seeds_find_the_same(spark, monkeypatch):
    """Which seeds count as frequent decides how pairs are found, not which."""
    rng = np.random.default_rng(15)

    def words(n, most=10**6):
        return [f"w{w}" for w in rng.integers(0, most, n)]

    lines, docs = [words(n) for n in (6, 9, 13, 13, 20, 30)], []
    for i in range(150):
        own = []
        for _ in range(rng.integers(1, 6)):
            own += words(rng.integers(0, 30)) + words(rng.integers(0, 40), 4) + lines[rng.integers(0, 6)]
        docs.append((i, own))
    for i in range(150):  # changed, cut and joined anew
        own = []
        for _ in range(2):
            other = docs[rng.integers(0, 150)][1]
            start = rng.integers(0, max(len(other) - 50, 1))
            part = other[start : start + rng.integers(40, 120)]
            for at in rng.integers(0, max(len(part), 1), len(part) // 8):
                part[at : at + 1] = [[], [f"c{i}x{at}"], [f"c{i}x{at}", part[at] if at < len(part) else "c"]][rng.integers(0, 3)]
            own += part
        docs.append((200 + i, own))
    docs = frame(spark, [(i, " ".join(own)) for i, own in docs])
    found = {}
    for most in (1, 8, 10**6):
        monkeypatch.setattr(passages, "OWNERS", most)
        found[most] = {(r.doc_id, r.ref_doc_id) for r in passages.find_passages(docs).collect()}
    assert found[1] == found[8] == found[10**6] and len(found[1]) > 150


def test_matches_of_frequent_seeds_are_those_of_all_pairs():
    """Places repeat within documents and lie next to each other; the first match of each run is a head."""
    rng = np.random.default_rng(16)
    texts = [[*rng.integers(2, 5, rng.integers(4, 40)).tolist()] for _ in range(30)]
    buckets, blocks = 6, 3
    words = [np.array(text, "<u4") << 24 for text in texts]
    rows = [(i, i % 2 << 32, body.tobytes()) for i, body in enumerate(words)]
    batch = passages.batch_of(passages._WORDS_OF, list(zip(*rows)))

    def by_bucket(*batches):
        rows = [tuple(row.values()) for batch in batches for row in batch.to_pylist()]
        return iter([passages.batch_of(passages._PACKED, list(zip(*sorted(rows, key=lambda row: row[:2]))))])

    groups = [*passages._group_rows(by_bucket(*passages._seed_rows(buckets)([batch])))]
    pairs = [m for b in passages._first_matches(100)(groups) for m in zip(*(c.to_pylist() for c in b.columns))]
    wanted = {(rank, ref, place, ref_place) for rank, _, ref, place, ref_place in pairs}
    known = [*passages._occurrences(buckets, 1)(groups), *passages._byte_rows(buckets)([batch])]
    found, heads, tasks = [], {}, 0
    for task, own in passages._by_bucket(by_bucket(*passages._context_rows(blocks, buckets)(by_bucket(*known)))):
        parts = [passages.unpack(body) for _, body in own]
        one, other = divmod(task, blocks)

        def block_of(rank):
            return passages._bucket(passages.mixed(rank.astype(np.uint64)), buckets) * blocks // buckets

        seeds, tasks = passages.FrequentSeeds(parts, block_of, one, other), tasks + 1
        n = len(seeds.documents)
        block = block_of(seeds.documents)
        every = np.array([i * n + j for i in range(n) for j in range(i) if {block[i], block[j]} == {one, other}], np.int64)
        found += map(tuple, seeds.matches(every).tolist())
        for left, right, equal in seeds.heads(np.flatnonzero(seeds.number)):
            for i, j, own in zip(left.tolist(), right.tolist(), equal.tolist()):
                heads[tuple(int(v) for v in (seeds.rank[i], seeds.rank[j], seeds.place[i], seeds.place[j]))] = own
    assert tasks > 1 and len(found) == len(set(found)) and set(found) == wanted
    first = {m for m in wanted if (m[0], m[1], m[2] - 1, m[3] - 1) not in wanted}
    assert first <= set(heads) <= wanted and len(heads) < len(wanted)
    for (rank, ref, place, ref_place), equal in heads.items():
        left, right, x, y = texts[rank], texts[ref], place & passages.LOW, ref_place & passages.LOW
        assert equal == sum(left[x + k] == right[y + k] for k in range(-min(x, y), min(len(left) - x, len(right) - y)))


def test_passages_of_odd_rows(odd, none):
    assert passages.find_passages(odd).collect() == []
    assert passages.find_passages(none).collect() == []


def test_chains_follow_both_orders():
    anchors = [(i, i + 10) for i in range(0, 60, 5)] + [(30, 0), (3, 400)]
    best = passages.chains(anchors)[0]
    assert best == [(i, i + 10) for i in range(0, 60, 5)]
    far = passages.chains([(0, 0), (5, 5), (400, 400)])
    assert sorted(map(len, far)) == [1, 2]


def test_rising_anchors_need_no_tree(monkeypatch):
    rng = np.random.default_rng(5)
    cases = []
    for n in (1, 2, 30, 200):
        x, y = (np.cumsum(rng.integers(1, most, n)).tolist() for most in (40, 160))
        cases.append(list(zip(x, y)))
    # one more place far back takes the way over the tree, and cannot change chains of the others
    by_tree = [passages.chains([*case, (10**6, 0)]) for case in cases]
    monkeypatch.setattr(passages.PrefixMaximum, "before", None)
    monkeypatch.setattr(passages.PrefixMaximum, "put", None)
    for case, found in zip(cases, by_tree):
        assert sorted(passages.chains(case)) == sorted(path for path in found if path != [(10**6, 0)])


def test_pairs_that_cannot_reach_enough_free_words_are_not_chained(monkeypatch):
    calls = []
    monkeypatch.setattr(passages, "chains", lambda anchors: calls.append(anchors) or [])
    few, many = range(40, 40 + passages.LEAST_NEW - passages.SHINGLE), range(40, 41 + passages.LEAST_NEW - passages.SHINGLE)
    covers = [(9, passages.COVER, 0, 0, 43), (8, passages.COVER, 0, 0, 43)]
    matches = [(8, passages.MATCH, 1, at, at) for at in [*range(20, 40), *few]]
    matches += [(9, passages.MATCH, 2, at, at) for at in [*range(20, 40), *many]]
    matches += [(7, passages.MATCH, 1, at, at) for at in few]
    rows = sorted(covers + matches)
    assert list(passages._chain_rows(iter([passages.batch_of(passages._MATCHES, list(zip(*rows)))]))) == []
    free = [sum(x + passages.SHINGLE > 43 for x, _ in anchors) for anchors in calls]
    assert len(calls) == 2 and calls[0][0][0] == 40 and calls[1][0][0] == 20, free


def test_chains_of_a_common_line_alone_are_not_aligned(monkeypatch):
    """Too few equal words along one run of equal words: no passage, whatever the alignment."""
    rng, calls, rows, wanted = np.random.default_rng(12), [], [], []
    align = passages.align
    monkeypatch.setattr(passages, "align", lambda *args: calls.append(args) or align(*args))
    for chain, line in enumerate([13, 20, 36, 39, 40, 44, 60] * 20):
        left, right = rng.integers(0, 60, (2, 160), np.uint32)
        start, shift = (int(n) for n in rng.integers(20, 60, 2))
        right[start + shift - 20 : start + shift - 20 + line] = left[start : start + line]
        line = min(line, 160 - start, 180 - start - shift)
        places = [*range(start, start + line - passages.SHINGLE + 1, passages.SHINGLE), start + line - passages.SHINGLE]
        anchors = sorted({(at, at + shift - 20) for at in places})
        found = align(left, right, anchors)
        wanted += [(chain, *stretch) for stretch in found]
        body = np.array(anchors, "<u4").tobytes()
        rows += [(chain, 0, chain, 0, left.tobytes(), body), (chain, 1, 1000, 0, right.tobytes(), None)]
    batch = passages.batch_of(passages._EXCERPT, list(zip(*rows)))
    found = [row for out in passages._align_rows(iter([batch])) for row in out.to_pylist()]
    got = [(r["rank"], r["start_word"], r["end_word"], r["ref_start"], r["ref_end"], r["n_equal"]) for r in found]
    assert got == wanted and {0, 1} & {row[0] % 7 for row in wanted} == set()
    assert len({row[0] for row in wanted}) <= len(calls) <= 100  # all but the lines of 13 and 20 words, of 140 chains


def test_packed_matches_give_the_same_chains():
    rng = np.random.default_rng(13)
    n = 3000
    rank, ref = rng.integers(50, 80, n), rng.integers(0, 5, n)
    at = rng.integers(0, 400, n)
    matches = np.stack([rank, ref, at, at + 3 * ref], axis=1)
    covers = np.array([(r, 10 * (r % 7), 10 * (r % 7) + 60) for r in range(40, 70)])
    rows = [(r, passages.COVER, 0, s, e) for r, s, e in covers.tolist()]
    rows += [(r, passages.MATCH, *rest) for r, *rest in matches.tolist()]
    plain = passages._chain_rows(iter([passages.batch_of(passages._MATCHES, list(zip(*sorted(rows, key=lambda r: r[:2]))))]))

    def packed(buckets):
        frame = pa.RecordBatch.from_pydict(dict(zip(("rank", "start_word", "end_word"), covers.T.copy())))
        own = [*passages._packed_covers(buckets)([frame])]
        own += passages._packed_matches(lambda batches: passages._match_batches(matches), buckets)([])
        rows = [tuple(row.values()) for batch in own for row in batch.to_pylist()]
        return passages.batch_of(passages._PACKED, list(zip(*sorted(rows, key=lambda r: r[:2]))))

    wanted = sorted(tuple(row.values()) for batch in plain for row in batch.to_pylist())
    assert wanted
    for buckets in (1, 4):
        chained = passages._packed_chain_rows(iter([packed(buckets)]))
        assert sorted(tuple(row.values()) for batch in chained for row in batch.to_pylist()) == wanted


def test_chains_of_all_documents_at_once_are_the_same(monkeypatch):
    rng = np.random.default_rng(17)
    n = 4000
    rank, ref = rng.integers(50, 90, n), rng.integers(0, 5, n)
    at, shift = rng.integers(0, 600, n), 7 * ref + rng.integers(0, 2, n) * rng.integers(-9, 40, n)
    matches = np.stack([rank, ref, at + (rank % 2 << 32), at + shift + 50 + (ref % 2 << 32)], axis=1)
    runs = [matches[:300] + [0, 0, k, k] for k in range(30)]
    matches = np.unique(np.concatenate([matches, *runs]), axis=0)
    kind = np.full(len(matches), passages.MATCH)
    batch = passages.batch_of(passages._MATCHES, [matches[:, 0], kind, *matches[:, 1:].T])
    wanted = sorted(tuple(row.values()) for out in passages._chain_rows(iter([batch])) for row in out.to_pylist())
    calls, chains = [], passages.chains
    monkeypatch.setattr(passages, "chains", lambda anchors: calls.append(anchors) or chains(anchors))
    found = [tuple(row.values()) for out in passages._pair_chains(rng.permutation(matches)) for row in out.to_pylist()]
    assert sorted(found) == wanted and wanted
    few = [tuple(row.values()) for out in passages._pair_chains(matches, lambda rank, *_: np.zeros(len(rank))) for row in out.to_pylist()]
    assert set(few) < set(wanted)


def test_query_equals_sql(spark):
    from harness import compare

    result = queries.queries()["op5_exact_dedup"](spark, SF_DIR)
    sql = queries.oracle_sql()["op5_exact_dedup"]
    assert compare.differences(compare.connect(SF_DIR), result, sql) == []
    assert hashlib.sha256(b"").hexdigest() in {
        r.text_sha256 for r in block_naming.exact_groups(frame(spark, [(1, None)])).collect()
    }
