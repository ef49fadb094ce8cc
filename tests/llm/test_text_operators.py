"""Periodic runs, sentence pieces, turn repair and toxicity models against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from forecourt.llm import periods, pieces, textnum, toxicity, turnrepair

DOC = "doc_id long, text string"
HARD = [None, "", " \n\t ", "one", "a b c d e f", "a b c d e f", "Ünï 𝕏 word " * 3, "x" * 5000, "word " * 20_000, "▁ ▁a  b\x00c\n"]


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], DOC)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


# Periodic runs


def brute_runs(w):
    out, n = [], len(w)
    for p in range(1, n // 4 + 1):
        k = 0
        while k + p < n:
            s = k
            while k + p < n and w[k] == w[k + p]:
                k += 1
            length = k + p - s
            if length >= max(6, 4 * p) and not any(all(w[x] == w[x + q] for x in range(s, s + length - q)) for q in range(1, p)):
                out.append((s, length, p))
            k += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def loops(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        w = []
        while len(w) < rng.randrange(1, 100):
            w += rng.choices("abc"[: rng.randrange(1, 4)], k=rng.randrange(1, 9)) * rng.randrange(1, 8)
        yield w


def test_runs_of_many_loops_match_brute_force(spark):
    texts = [" ".join(w) for w in loops(1, 400)] + HARD[:-2] + ["b b b b b B b b b b b b c"]
    thue = [0]
    while len(thue) < 2048:
        thue += [1 - x for x in thue]
    texts.append(" ".join(map(str, thue)))
    rows = periods.collapse(frame(spark, texts).withColumn("runs", F.lit("mine"))).collect()
    for r in rows:
        w = (texts[r.doc_id] or "").split()
        want = brute_runs(w)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(w)
        assert r.collapsed == collapsed(w, want)
    long = periods.collapse(frame(spark, HARD)).where("doc_id = 8").first()
    assert [tuple(x) for x in long.runs] == [(0, 20_000, 1)] and long.collapsed == "word"
    assert periods.collapse(documents(spark).limit(0)).count() == 0


def test_runs_do_not_depend_on_how_words_arrive():
    rng = random.Random(2)
    for w in loops(3, 300):
        h = textnum.mix(np.array([ord(x) for x in w], np.uint64))
        catchers, found, at = periods.Catchers(len(h)), [], 0
        while at < len(h):
            step = rng.randrange(1, 30)
            found += catchers.append(h[at : at + step])
            at += step
        found += catchers.append(h[:0], final=True)
        assert sorted(found, key=lambda r: (r[0], r[2])) == brute_runs(w)


def test_run_query_digests(spark):
    docs = documents(spark).unionByName(frame(spark, HARD[:-2], 10**6)).unionByName(spark.createDataFrame([(None, "a a a a a a a")], DOC))
    got = {r.doc_id: r for r in periods.digest(periods.collapse(periods.with_planted_runs(docs))).collect()}
    planted = 0
    for doc, text in docs.collect():
        w = (text or "").split()
        h = 1 if doc is None else zlib.crc32(str(doc).encode())
        g, n = h // 10, len(w)
        if n > 900:
            continue
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs, r = brute_runs(w), got[doc]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert (r.n_runs, (r.start, r.length, r.period)) == (len(runs), best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted > 10


# Sentence pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_agree_with_the_library(spark):
    rng = random.Random(5)
    odd = ["".join(rng.choices(" ab▁é\n.世\U0001d54f<s>", k=rng.randrange(40))) for _ in range(500)]
    docs = documents(spark).unionByName(frame(spark, HARD + odd, 10**6)).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(1))
    rows = pieces.decode(pieces.encode(docs, MODEL), MODEL).collect()
    lib = pieces.Vocabulary(open(MODEL, "rb").read()).library
    assert len(rows) == docs.count() and all(r.agrees and r.decodes for r in rows)
    for r in rows:
        want = lib.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want) and r.decoded == lib.decode(want)
    plain = pieces.decode(pieces.encode(docs.limit(3), MODEL, check=False), MODEL, check=False)
    assert plain.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"] and plain.count() == 3
    both = pieces.encode(docs, MODEL, back=True, keep=["doc_id"])
    assert both.columns == ["doc_id", "n_tokens", "ids", "agrees", "decoded", "decodes"]
    key = lambda r: (r.doc_id, r.ids, r.decoded)
    assert sorted(map(key, both.collect())) == sorted(map(key, rows))
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert pieces.decode(nothing, MODEL).first().decoded == ""


def test_any_ids_decode_like_the_library():
    words, rng = pieces.Vocabulary(open(MODEL, "rb").read()), random.Random(6)
    mark = words.pieces.index(pieces.MARK)
    for _ in range(20_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(300), mark]) for _ in range(rng.randrange(8))]
        assert words.decode(ids) == words.library.decode(ids), ids


def test_merges_follow_the_agenda():
    words = pieces.Vocabulary(open(MODEL, "rb").read())
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choices("theaning▁", k=rng.randrange(1, 25)))
        part = list(text)
        while True:  # all pairs anew at every step
            best = min(((words.cost[a + b], k) for k, (a, b) in enumerate(zip(part, part[1:])) if a + b in words.cost), default=None)
            if best is None:
                break
            part[best[1] : best[1] + 2] = [part[best[1]] + part[best[1] + 1]]
        got = [words.pieces[i] for i in np.frombuffer(words.merged([text])[0], "<u4").tolist()]
        assert words._merged_long(text) == part and got == part


# Turn repair


def brute_repair(rows):
    """The cheapest edits of ``(role, text, fault)`` rows by trying all of them."""
    best = None
    n = len(rows)
    for kinds in product("DKR", repeat=n):
        if any(k != "D" and f in ("blank", "duplicate") for k, (_, _, f) in zip(kinds, rows)):
            continue
        cost = sum({"D": 3, "K": 0, "R": 2}[k] + (k != "D" and f == "truncated") for k, (_, _, f) in zip(kinds, rows))
        for inserts in product(range(3), repeat=n + 1):
            total = cost + 2 * sum(inserts)
            if best and total > best[0]:
                continue
            audit, said = "", []
            for k, (role, text, _) in zip(kinds, rows):
                audit += "I" * inserts[len(audit) - audit.count("I")] + k
            audit += "I" * inserts[n]
            if best and (total, audit) >= best[:2]:
                continue
            given, fits = iter(rows), True
            for e in audit:
                row = None if e == "I" else next(given)
                if e == "D":
                    continue
                opened = bool(said) and said[-1][0][:1] == "u"
                role = row[0] if e == "K" else "assistant" if opened else "user"
                first = role[:1]
                fits = fits and (first == "a" if opened else first == "u" or (first == "s" and not said))
                said.append((role, row[1] if row else ""))
            if fits and (not said or said[-1][0][:1] == "a"):
                best = (total, audit, said)
    return best


def brute_faults(rows):
    out, seen = [], set()
    for role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        out.append((role, text, "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None))
        seen.add((role, text))
    return out


def some_turns(n, seed):
    rng = random.Random(seed)
    for conv in range(n):
        for turn in rng.sample([None, *range(9)], rng.randrange(0, 5)):
            yield conv, turn, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["yes.", "no", "so?", "", " \n", None, "much more!"])


SHAPE = "conv_id long, turn long, role string, text string"


def digests(rows, turns):
    return {r.conv_id: r for r in turnrepair.digest(rows, turns).collect()}


def check_repairs(got, said, conv):
    rows = sorted(said, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    faults = brute_faults([r[1:] for r in rows])
    cost, audit, left = brute_repair(faults)
    r = got[conv]
    counts = Counter(f for _, _, f in faults)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(faults, faults[1:])]
    turns = {t for t, _, _ in rows if t is not None}
    assert (r.cost, r.audit) == (cost, audit)
    assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in left).encode()).hexdigest()
    assert (r.blank, r.duplicate, r.truncated) == (counts["blank"], counts["duplicate"], counts["truncated"])
    assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
    assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)


def test_turn_repair_matches_all_edits(spark):
    turns = list(some_turns(120, 8)) + [(None, 1, "user", "hm."), (200, None, "", "no role."), (200, None, "", "no role.")]
    rows = spark.createDataFrame([(*t, 7, "x") for t in turns], SHAPE + ", at long, fault string")
    got = digests(turnrepair.repair(rows), rows)
    held = defaultdict(list)
    for conv, turn, role, text in turns:
        held[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert set(got) == set(held)
    for conv, said in held.items():
        check_repairs(got, said, conv)
    assert turnrepair.repair(rows.limit(0)).count() == 0 and digests(turnrepair.repair(rows.limit(0)), rows.limit(0)) == {}


def test_conversations_without_rows_left(spark):
    rows = spark.createDataFrame([(5, 1, "user", "a."), (6, 1, "user", "b.")], SHAPE)
    got = digests(turnrepair.repair(rows.where("conv_id = 6")), rows)
    assert (got[5].cost, got[5].audit, got[5].gaps, got[5].repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest())


def test_pieces_of_a_conversation_chain_to_the_whole():
    rng = random.Random(9)
    for _ in range(300):
        rows = [(rng.choice(["s", "u", "a", "t"]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(1, 25))]
        whole = list(turnrepair.edits(rows))
        cuts = sorted(rng.sample(range(len(rows) + 1), 2))
        parts = [p for p in (rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]) if p]
        ends, inserts, cost = turnrepair.chain([turnrepair.table(p) for p in parts])
        chained = [e for k, (p, (a, b)) in enumerate(zip(parts, ends)) for e in turnrepair.edits(p, a, b, inserts if k == len(parts) - 1 else 0)]
        assert chained == whole
        assert cost == sum(turnrepair.COST[e] for e, _ in whole) + sum(
            cut for (_, _, cut), e in zip(rows, [e for e, _ in whole if e != "I"]) if e != "D")


def test_a_long_conversation_is_repaired_by_many_tasks(spark):
    rng = random.Random(10)
    roles = [rng.choice(["user", "assistant", "assistant", "system"]) for _ in range(3000)]
    rows = spark.createDataFrame([(1, t, r, f"turn {t}.") for t, r in enumerate(roles)] + [(2, 0, "user", "hi."), (2, 1, "assistant", "ho.")], SHAPE)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    repaired = turnrepair.repair(rows)
    spark.conf.unset(small)
    assert repaired.where("conv_id = 1").select("piece").distinct().count() > 1
    want = list(turnrepair.edits([(r[:1], False, False) for r in roles]))
    got = digests(repaired, rows)
    assert got[1].audit == "".join(e for e, _ in want) and got[2].audit == "KK"


def test_damage(spark):
    turns = spark.createDataFrame([(c, t, "assistant", "Well. Yes?") for c in range(60) for t in range(4)] + [(None, None, None, None)], SHAPE)
    got = {(r.conv_id, r.turn): r for r in turnrepair.damaged(turns).collect()}
    kinds = set()
    for c, t, _, _ in turns.collect():
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        kinds.add(kind)
        role, text = (" ", " ") if c is None else ("assistant", "Well. Yes?")
        want = {1: (role, "", 1), 2: (role, re.sub("[.!?]", "", text), 1), 3: (role, text, 2), 4: ("user", text, 1)}.get(kind, (role, text, 1))
        assert (c, t) not in got if kind == 0 else tuple(got[c, t])[2:] == want
    assert kinds >= set(range(5))


# Toxicity


def brute_ratio(train, text):
    """Log ratio by interpolated Kneser-Ney with dictionaries."""
    split = lambda t: [w for w in re.split(r"[\x00-/:-@\[-`{-\x7f]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]
    n = Counter(), Counter()
    for toxic, t in train:
        n[toxic].update(split(t))
    cont = Counter([*n[0], *n[1]])

    def discount(values):
        one, two = sum(v == 1 for v in values), sum(v == 2 for v in values)
        return one / (one + 2 * two) if one and two else 0.5

    d, total, types = discount(cont.values()), sum(cont.values()), len(cont)

    def shared(w):
        return (max(cont.get(w, 0) - d, 0) + d * types / (types + 1)) / total

    def p(c, w):
        dc, all_ = discount(n[c].values()), sum(n[c].values())
        return (max(n[c][w] - dc, 0) + dc * len(n[c]) * shared(w)) / all_

    words = split(text)
    return sum(math.log(p(1, w) / p(0, w)) for w in words) / (len(words) + toxicity.STEADY)


def test_toxicity_models_match_plain_kneser_ney(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["good", "day", "the", "Idiot", "fool", "x,y", "été", "rare%d" % rng.randrange(40)], k=rng.randrange(0, 30))) for _ in range(80)]
    docs, classes = frame(spark, texts + [None, "Idiot, new words"]), [int(i % 4 == 0) for i in range(60)]
    counts = toxicity.word_counts(docs, np.arange(60), np.array(classes))
    assert counts.agg(F.sum(F.col("n0") + F.col("n1"))).first()[0] == sum(len(re.findall(r"[^\W_]+", t)) for t in texts[:60])
    model = toxicity.model_of(counts)
    got = {r.doc_id: r.raw for r in toxicity.raw_scores(docs, model).collect()}
    train = list(zip(classes, texts))
    assert len(got) == 82
    for i, t in enumerate([*texts, None, "Idiot, new words"]):
        assert got[i] == pytest.approx(brute_ratio(train, t), abs=1e-9)


def test_toxicity_sample_is_halved_until_the_model_fits(spark):
    docs = frame(spark, [f"word{i} other{i} same" for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic long")
    assert len(toxicity.fit(docs, labels).words) > 400
    assert 0 < len(toxicity.fit(docs, labels, most_words=200).words) <= 200


def test_toxicity_ranks_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), labels).where("held_out").join(labels, "doc_id").collect()
    bad, good = ([r.score for r in rows if r.toxic == c] for c in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in bad for b in good)
    assert wins / (len(bad) * len(good)) >= 0.74
