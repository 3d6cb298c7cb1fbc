"""LM scoring, conversation repair and ranked search against brute force."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from harness import compare
from lendlens.llm import class_model, queries, ranked_search, repair
from tests.llm.conftest import ODD, SF_DIR, frame

TALK = "conv_id long, turn long, role string, text string, edits int, `first` int"


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def brute_base(docs):
    counts = Counter(t for i, text in docs if not is_held_out(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)

    def one(text):
        tokens = tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in tokens)
        return len(tokens), sum(counts[t] > 0 for t in tokens), n, base

    return counts, one


def brute_score(docs, classes, counts):
    """The model's probability from its classes alone, all else counted anew."""
    bigrams, members = Counter(), Counter({class_model.RARE: 1})
    for i, text in docs:
        if not is_held_out(i):
            before = b""
            for token in tokens_of(text):
                bigrams[classes[before], classes[token]] += 1
                before = token
    for token, n in counts.items():
        members[classes[token]] += n + 1
    size, out = sum(members.values()), Counter()
    for (left, _), n in bigrams.items():
        out[left] += n
    alpha = class_model.SMOOTHING

    def log_prob(before, token):
        left, right = (classes.get(t, class_model.RARE) for t in (before, token))
        move = (bigrams[left, right] + alpha * members[right] / size) / (out[left] + alpha)
        return math.log10(move * (counts[token] + 1) / members[right])

    return log_prob


@pytest.fixture(scope="module")
def learned(spark, documents):
    docs = documents + [(i if i is None else 90_000 + i, t) for i, t in ODD]
    model = class_model.learn(frame(spark, docs), rounds=3)
    return docs, model, model.scores().collect()


def test_base_scores_and_counts(learned):
    docs, _, rows = learned
    _, one = brute_base(docs)
    found = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in rows)
    assert found == sorted((i or -1, is_held_out(i), *one(t)[:3]) for i, t in docs)
    wanted = sorted((i or -1, one(t)[3]) for i, t in docs)
    for (i, value), (j, base) in zip(sorted((r.doc_id or -1, r.base_score) for r in rows), wanted):
        assert i == j and value == pytest.approx(base, rel=1e-9)


def test_scores_are_those_of_the_classes_and_sum_to_one(learned):
    docs, model, rows = learned
    counts, _ = brute_base(docs)
    words = {bytes(r.word): (r.n, r["class"]) for r in model.word_classes().collect()}
    assert {w: n for w, (n, _) in words.items()} == counts
    classes = {w: c for w, (_, c) in words.items()}
    assert all((c == class_model.RARE) == (counts[w] < class_model.LEAST_COUNT) for w, c in classes.items())
    log_prob = brute_score(docs, classes, counts)
    for before in (b"", next(w for w in counts if w), b"never seen"):
        whole = sum(10 ** log_prob(before, w) for w in [*counts, b"one unseen word"])
        assert whole == pytest.approx(1, rel=1e-9)
    score = {}
    for i, text in docs:
        tokens = tokens_of(text)
        score[i, len(tokens)] = sum(map(log_prob, [b"", *tokens], tokens))
    for r in rows:
        assert r.score == pytest.approx(score[r.doc_id, r.n_tokens], rel=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens), rel=1e-9)


def test_classes_predict_held_out_texts_better(learned):
    _, _, rows = learned
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_a_move_is_to_the_likeliest_class():
    """Against the likelihood counted anew, for words that meet their class seldom."""
    rng = np.random.default_rng(3)
    k = class_model.CLASSES
    cells = np.zeros((k, k))
    cells[1:5, 1:5] = rng.integers(500, 5000, (4, 4))
    contexts = np.zeros((6, 2 * k), np.int64)
    contexts[:, 1:5], contexts[:, k + 1 : k + 5] = rng.integers(0, 30, (2, 6, 4))
    counts = contexts[:, :k].sum(1)
    contexts[:, k + 5] = counts - contexts[:, k : k + 5].sum(1) + 200  # as many to its right
    counts = contexts[:, k:].sum(1)
    contexts[:, 6] = counts - contexts[:, :6].sum(1)
    own = np.array([1, 2, 3, 4, 1, 2])
    for i in range(6):
        whole = cells.copy()
        whole[:, own[i]] += contexts[i, :k]
        whole[own[i]] += contexts[i, k:]
        best = class_model.best_classes(contexts[[i]], counts[[i]], own[[i]], whole)[0]
        value = {}
        for c in range(1, k):
            moved = cells.copy()
            moved[:, c] += contexts[i, :k]
            moved[c] += contexts[i, k:]
            value[c] = class_model.likelihood(moved)
        assert value[best] >= max(value.values()) - 0.002 * abs(max(value.values()) - value[own[i]]) - 1


def test_neighbours_are_counted_in_little_memory():
    k, n, size = class_model.CLASSES, 200_000, 300_000
    chance = np.random.default_rng(5)
    found = np.concatenate([np.arange(n), chance.integers(0, 50, size - n)]).astype(np.uint32)
    chance.shuffle(found)
    lengths = np.full(3, size // 3)
    held = np.array([0, 1, 0], np.uint8)
    marked = (np.arange(n) % k + k * (np.arange(n) % 2)).astype(np.uint8)
    codes = np.arange(n, dtype=np.uint32)
    rows = [
        class_model._row(7, class_model.CLASS, bucket, class_model.pack(*(c[bucket::2].copy() for c in (codes, marked, codes))))
        for bucket in range(2)
    ]
    rows.append(class_model._row(7, class_model.TEXT, 0, class_model.pack(np.arange(3), held, lengths, found)))
    tracemalloc.start()
    counted = list(class_model._count(rows))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6  # a counter for each cell takes 102 MB

    expected, cells, neighbours = np.repeat(held, lengths) == 0, Counter(), Counter()
    for before, word in zip(np.roll(found, 1)[expected].tolist(), found[expected].tolist()):
        cells[before % k * k + word % k] += 1
        for centre, place in ((word, before % k), (before, k + word % k)):
            if marked[centre] >= k:
                neighbours[centre, place] += 1
    got = Counter()
    for batch in counted:
        row = batch.to_pylist()[0]
        if row["kind"] == class_model.CELLS:
            assert {i: count for i, count in enumerate(row["cells"]) if count} == cells
            continue
        own, place, counts = class_model.unpack(row["body"])
        assert (own % 2 == row["bucket"]).all()
        got.update(dict(zip(zip(own.tolist(), place.tolist()), counts.tolist())))
    assert got == neighbours


def test_scores_of_no_rows_and_of_nothing_learned(spark, none):
    assert class_model.score_texts(none).collect() == []
    held = next(i for i in range(100) if is_held_out(i))
    row = class_model.score_texts(frame(spark, [(held, "some words")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert (row.score, row.perplexity) == (pytest.approx(0.0), pytest.approx(1.0))


# Conversation repair


def brute_damage(conv, turn, role, text):
    conv, at, role, text = (" " if x is None else x for x in (conv, turn, role, text))
    kind = zlib.crc32(f"{conv}:{at}".encode()) % 20
    text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
    row = (turn, "user" if kind == 4 else role, text)
    return [] if kind == 0 else [row] * (2 if kind == 3 else 1)


def brute_repair(rows):
    """All states with their whole strings: cost, audit, repaired rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        said = text.strip(repair.SPACES)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("" if said[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {(0, ""): (0, "", ())}

    def offer(key, value):
        if key not in best or value < best[key]:
            best[key] = value

    for i in range(len(rows) + 1):
        for _ in range(3):
            for state in ("", "s", "u", "a"):
                cost, audit, out = best.get((i, state), (None, "", ()))
                for role in ("user", "assistant"):
                    if cost is not None and (state, role[0]) in steps:
                        offer((i, steps[state, role[0]]), (cost + 5, audit + "I", (*out, f"{role}:")))
        for state in ("", "s", "u", "a") if i < len(rows) else ():
            if (i, state) not in best:
                continue
            cost, audit, out = best[i, state]
            offer((i + 1, state), (cost + 2, audit + "D", out))
            if faults[i] in ("blank", "duplicate"):
                continue
            _, own, text = rows[i]
            more = 5 if faults[i] == "truncated" else 0
            for edit, price, role in (("K", 0, own), ("R", 1, "user"), ("R", 1, "assistant")):
                if (state, role[:1]) in steps:
                    offer((i + 1, steps[state, role[:1]]), (cost + price + more, audit + edit, (*out, f"{role}:{text}")))
    cost, audit, out = min(best[k] for k in ((len(rows), ""), (len(rows), "a")) if k in best)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def odd_talk():
    rng = random.Random(5)
    rows = []
    for conv in range(80):
        for _ in range(rng.choice([1, 3, 8, 30, 60])):
            turn = rng.choice([None, *range(40)])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["hi.", "no", "", "what?", None, f"x{rng.random()}.", f"y{rng.random()}", "é! "])
            rows.append((conv or None, turn, role, text))
    return rows + [(900, t, "user" if t % 2 else "assistant", f"long {t % 90}.") for t in range(400)]


@pytest.mark.parametrize("nodes", [40, repair.COMPACT_NODES])
def test_repair_equals_brute_force(spark, monkeypatch, nodes):
    monkeypatch.setattr(repair, "COMPACT_NODES", nodes)
    stored = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in stored.collect()] + odd_talk()
    rows += rows[:20]
    talk = spark.createDataFrame([(*r, 1, 2) for r in rows], TALK)
    damaged = repair.damage(talk)
    audits = repair.audit(damaged)
    wanted = defaultdict(list)
    for row in rows:
        wanted[row[0]] += brute_damage(*row)
    found = {r.conv_id: tuple(r)[1:] for r in audits.collect()}
    assert found == {conv: brute_repair(left) for conv, left in wanted.items()}
    lines = defaultdict(list)
    for r in repair.repaired(damaged, audits).orderBy("conv_id", "at").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    digests = {conv: hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() for conv in found}
    assert digests == {conv: row[-1] for conv, row in found.items()}


def test_repair_of_no_rows(spark):
    empty = spark.createDataFrame([], TALK)
    assert repair.audit(repair.damage(empty)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    talk = spark.createDataFrame([(gone, 0, "user", "hi.", 1, 2)], TALK)
    row = repair.audit(repair.damage(talk)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("prime", [repair.PRIME, 7])
def test_edit_strings_compare_also_where_hashes_collide(monkeypatch, prime):
    monkeypatch.setattr(repair, "PRIME", prime)
    rng = random.Random(1)
    edits, texts = repair.Edits([]), [""]
    for _ in range(300):
        parent, letter = rng.randrange(len(texts)), rng.choice("DIKR")
        assert edits.add(parent, letter) == len(texts)
        texts.append(texts[parent] + letter)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        if texts[a] != texts[b]:
            assert edits.less(a, b) == (texts[a] < texts[b])
    nodes = [n for n in range(len(texts)) if texts[n].startswith("K")][:4]
    left, moved = edits.compact(nodes)
    assert [left.text(n) for n in moved] == [texts[n] for n in nodes]


# Ranked search


def brute_search(docs, items):
    cut = [(i, ranked_search.terms((t or "").encode())) for i, t in docs]
    df = Counter(term for _, own in cut for term in set(own))
    n_docs, n_terms = sum(bool(own) for _, own in cut), sum(len(own) for _, own in cut)
    result = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        query, found = set(ranked_search.terms(text.encode())), []
        for doc_id, own in cut:
            tf = Counter(own)
            m = 100 - 90 + (90 * len(own) * n_docs) // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in query & set(own)
            )
            if score > 0:
                found.append((-score, doc_id if doc_id is not None else -(2**63), doc_id))
        found.sort()
        result += [(item, rank + 1, d, -s) for rank, (s, _, d) in enumerate(found[:10])]
    return sorted(result, key=str)


@pytest.mark.parametrize("shard, block", [(2_000, 300), (ranked_search.SHARD_BYTES, ranked_search.BLOCK_BYTES)])
def test_search_equals_brute_force(spark, documents, monkeypatch, shard, block):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()][:6]
    items += [(900, None), (901, ""), (902, "same words here"), (902, "the LONG end"), (902, "the LONG end"), (None, "é ß 漢字")]
    docs = documents[:90] + documents[:12] + [(i if i is None else 90_000 + i, t) for i, t in ODD]
    benchmark = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, item int, score int")
    rows = ranked_search.search(frame(spark, docs), benchmark).collect()
    assert sorted(map(tuple, rows), key=str) == brute_search(docs, items)


def test_search_stops_opening_accumulators_and_stays_exact():
    rng = np.random.default_rng(0)
    numbers = {f"t{i}".encode(): i for i in range(8)}
    docs = [(i, " ".join(f"t{j}" for j in range(8) if rng.random() < 0.9 / (8 - j))) for i in range(3000)]
    cut = [ranked_search.terms(t.encode()) for _, t in docs]
    df = Counter(t for own in cut for t in set(own))
    n_terms = sum(map(len, cut))
    n_docs = sum(map(bool, cut))
    query = sorted((df[t], i) for t, i in numbers.items())
    pairs = [(i, ranked_search.weight(n_docs, n)) for n, i in query]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs]), pa.array([t.encode() for _, t in docs])], ["doc_id", "text"])
    body = list(ranked_search._index(numbers)(iter([batch])))[0].column("body")[0].as_py()
    shard = ranked_search.Shard(body, n_docs, n_terms)
    _, opened = shard.accumulate(pairs, 10, 0)
    assert opened.sum() < 0.7 * n_docs
    ids, scores = shard.search(pairs, 10, 0)
    brute = brute_search([(i, t) for i, t in docs], [(1, " ".join(f"t{i}" for i in range(8)))])
    assert sorted(zip(ids.tolist(), scores.tolist())) == sorted((d, s) for _, _, d, s in brute)


def test_search_of_no_rows(spark, none, odd):
    benchmark = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    assert ranked_search.search(none, benchmark).collect() == []
    assert ranked_search.search(odd, benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_statement(spark, name):
    duck = compare.connect(SF_DIR)
    sql = queries.oracle_sql()[name]
    assert compare.differences(duck, queries.queries()[name](spark, SF_DIR), sql) == []
