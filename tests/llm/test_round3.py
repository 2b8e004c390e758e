"""Conversation repair, sum-of-squares packing and importance resampling against brute force; every operator's SQL on the smallest tables."""

import hashlib
import itertools
import math
import os
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from solidspark.llm import decontam, html_extract, lm, minhash, packing, quality, queries, resample, simhash, substring, sumsquares, turns

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return (text or "").encode().lower().decode()


# 11: conversation repair


def damage(rows):
    out = []
    for c, t, role, text in rows:
        one = lambda x: " " if x is None else str(x)
        code = zlib.crc32(f"{one(c)}:{one(t)}".encode()) % 20
        role, text = one(role), one(text)
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(c, t, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))


STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FITS = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def cheapest(rows):
    """All edits of every row with up to two inserts before it and at the end, by plain recursion: (cost, audit, lines)."""
    found, seen = [], set()

    def faults():
        out = []
        for _, _, role, text in rows:
            z = text.strip(" \t\n\x0b\x0c\r")[-1:]
            out.append("b" if not z else "d" if (role, text) in seen else "" if z in ".!?" else "t")
            seen.add((role, text))
        return out

    fault = faults()
    best = {(0, 0): [(0, "", ())]}

    def options(i, state):
        yield 3, "D", state, ()
        if fault[i] not in ("b", "d"):
            role, text, more = rows[i][2], rows[i][3], fault[i] == "t"
            if (state, role[:1]) in STEP:
                yield more, "K", STEP[state, role[:1]], (f"{role}:{text}",)
            yield 2 + more, "R", STEP[state, FITS[state][0]], (f"{FITS[state]}:{text}",)

    def inserted(paths):
        for state, cost, audit, lines in paths:
            for k in range(4):
                yield state, cost, audit, lines
                cost, audit, lines, state = cost + 2, audit + "I", (*lines, f"{FITS[state]}:"), STEP[state, FITS[state][0]]

    paths = [(0, 0, "", ())]
    for i in range(len(rows)):
        paths = [(t, c + p, a + op, lines + more) for s, c, a, lines in inserted(paths) for p, op, t, more in options(i, s)]
        if len(paths) > 4000:  # long ones: of each state the cheapest few of all are enough, as no audit here is a prefix of another
            paths = [x for s in range(4) for x in sorted((x for x in paths if x[0] == s), key=lambda x: x[1:3])[:3]]
    found = [(c, a, lines) for s, c, a, lines in inserted(paths) if s in (0, 3)]
    del best
    return fault, min(found, key=lambda x: x[:2])


def wanted(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for c, own in by.items():
        own = damage(own)
        fault, (cost, audit, lines) = cheapest(own)
        real = {t for _, t, _, _ in own if t is not None}
        gaps = max(real) - min(real) + 1 - len(real) if real else 0
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit, sha)
    return out


def turns_of(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit(1) for c in ("seg", "i", "audit", "key", "code", "g")}).repartition(partitions)


def repaired(df, **how):
    return {r.conv_id: tuple(r)[1:] for r in turns.repair(df, **how).collect()}


def conversations(rng, n, longest):
    said = ["Yes.", "No!", "Why", "", " \t", "Well? ", "no end", "A. b", "é…"]
    out = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            out.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice([*said, f"Turn {t}.", None])))
    return out


def test_repair(spark):
    rng = random.Random(3)
    rows = conversations(rng, 60, 5)
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (900, None, None, None), (900, None, "user", "x" * 100_000 + ".")]
    rows += rows[:10]
    assert repaired(turns_of(spark, rows)) == wanted(rows)
    dropped = next(c for c in itertools.count(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(turns_of(spark, [(dropped, 0, "user", "Hi.")])) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repaired(turns_of(spark, rows).limit(0)) == {}


def test_repair_of_long_conversations_in_stretches(spark):
    rng = random.Random(4)
    rows = conversations(rng, 3, 60) + [(50, t, rng.choice(["user", "assistant"]), f"{t}.") for t in range(150)] + [(51, 7, "user", "Same.")] * 40
    want = wanted(rows)
    assert repaired(turns_of(spark, rows)) == want
    assert repaired(turns_of(spark, rows), stretch=3, batch_rows=7) == want


# 12: sum-of-squares packing


def packed(docs, **how):
    rows = docs.collect()
    got = sumsquares.pack(docs, BYTES, 2048, keep_ids=True, **how).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    ids = Counter((r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *itertools.accumulate(r.length for r in own)][:-1]
    return ids, by_doc, [sum(r.length for r in own) for own in by_sequence.values()]


def whole(by_doc, ids):
    """Documents put together from their pieces, those that repeat an id and a length by turns."""
    out = Counter()
    for (doc, n), pieces in by_doc.items():
        starts = defaultdict(list)
        for p in pieces:
            starts[p.start].append(p)
        while starts:
            at, text = 0, ()
            while at < n:
                p = starts[at].pop()
                if not starts[at]:
                    del starts[at]
                at, text = at + p.length, (*text, *p.ids)
            out[doc, text] += 1
    return out == ids


def test_packing(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7)))
    texts = [None, "", " ", "<|endoftext|> a", "a\n\n\nb", *[" ".join(word() for _ in range(rng.choice((3, 40, 300, 900)))) for _ in range(150)], " ".join(word() for _ in range(9000))]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)] + [(None, "no id", "en", "s", 0)] * 2 + [(2**53 + 1, "far", "en", "s", 0)], DOCS)
    docs = docs.withColumns({c: F.lit(1) for c in ("start", "length", "ids", "offset")}).repartition(3)
    ids, by_doc, fills = packed(docs)
    assert whole(by_doc, ids)
    assert sum(fills) == sum(len(i) * n for (_, i), n in ids.items())
    assert all(f <= 2048 and f & (f - 1) == 0 for f in fills)
    assert sum(f < 2048 for f in fills) <= 3 * 11 + 40
    ids, by_doc, fills = packed(docs, most_open=4)
    assert whole(by_doc, ids) and all(f <= 2048 and f & (f - 1) == 0 for f in fills)
    assert sumsquares.pack(docs.limit(0), BYTES).count() == 0


def test_level_for_minimises_the_sum_of_squares():
    rng, levels = random.Random(2), sumsquares.SumOfSquares(64, 10**9)
    counted = [h for h in range(1, 64) if h & (h - 1)]
    for k in range(3000):
        size = rng.choice((5, 9, 17, 30, 31, 40))
        now = {h: len(levels.levels[h]) for h in range(1, 64)}

        def sum_after(h, now=now, size=size):
            n = Counter(now)
            if h:
                n[h] -= 1
            n[h + size] += 1
            return sum(n[x] ** 2 for x in counted)

        allowed = [h for h in range(64 - size + 1) if not h or now[h]]
        least = min(map(sum_after, allowed))
        assert levels.level_for(size) == max(h for h in allowed if sum_after(h) == least)
        list(levels.place((k, 0, bytes(4 * size))))


def test_one_length_keeps_few_windows_open():
    levels = sumsquares.SumOfSquares(2048, 50)
    done = [w for k in range(1000) for w in levels.place((k, 0, bytes(4 * 1500)))]
    assert levels.n_open <= 50
    done += levels.settle()
    sizes = [sum(len(p[2]) // 4 for p in w) for w in done]
    assert sum(sizes) == 1_500_000 and all(s & (s - 1) == 0 for s in sizes) and len(sizes) <= 1_500_000 // 2048 + 12


def test_part_encoder_equals_the_tokenizer():
    rng, encoder = random.Random(1), sumsquares.PartEncoder(BYTES, 300)
    some = [" ", " ", "  ", "\n", "\n", "\t", "a", "B", "é", "'s", "'", "'ll", "1", "٣", "!", "...", "word", "Word", "\x85", "\xa0", "\x1c", "\x0b", "​", "日", "😀", "\r\n", "<|endoftext|>", "　", "́", "\0"]
    for _ in range(20):
        cases = ["".join(rng.choice(some) for _ in range(rng.randint(0, 12))) for _ in range(400)]
        assert encoder.encode(pa.array([*cases, None])) == [*encoder.whole(cases), b""]


# 13: importance resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def drawn(rows, targets, percent=25, least=20):
    def features(text):
        w = WORDS.findall(lower(text))
        return w, [zlib.crc32(x.encode()) % 10_000 for x in [*w, *map(" ".join, itertools.pairwise(w))]]

    per = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for _, _, f in per for b in f), Counter(b for x in targets for b in features(x)[1])
    n, m = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n + 10_000) / ((s[b] + 1) * (m + 10_000))))
    out, eligible = [], []
    for d, w, f in per:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(w) >= least:
            eligible.append(out[-1])
    for k, r in enumerate(sorted(eligible, key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))[: percent * len(eligible) // 100]):
        r[4] = k + 1
    return Counter(map(tuple, out))


def resampled(spark, rows, targets):
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).withColumns({c: F.lit(1) for c in ("score", "rank", "part", "weight")}).repartition(3)
    return docs, spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "item_id long, text string")


def test_resampling(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcXYZ0é") for _ in range(rng.randint(1, 3)))
    text = lambda: rng.choice([" ", ", ", "\0", "\n"]).join(word() for _ in range(rng.randint(10, 60)))
    rows = [(k, text()) for k in range(300)]
    rows += [(400, None), (401, ""), (402, "..."), (None, text()), (None, text()), (2**53 + 1, text()), (5, text()), (403, "é" * 300 + " " + "z" * 90 + " b" * 30), *rows[:30]]
    targets = [text()[:80] for _ in range(9)] + [None]
    docs, target = resampled(spark, rows, targets)
    want = drawn(rows, targets)
    assert Counter(map(tuple, resample.resample(docs, target).collect())) == want
    gain = resample.gains(resample.bucket_counts(docs, "text", 10_000), resample.bucket_counts(target, "text", 10_000))
    scored = resample.scored(docs, gain, "doc_id", "text", 20, 7)
    for how in ({"run_rows": 5, "range_rows": 7, "ways": 2}, {"run_rows": 9, "range_rows": 10**6, "ways": 3}):
        assert Counter(map(tuple, resample.draw(scored, 25, **how).collect())) == want
    assert Counter(map(tuple, resample.draw(scored, 100, run_rows=16).collect())) == drawn(rows, targets, 100)
    assert Counter(map(tuple, resample.resample(docs, target.limit(0)).collect())) == drawn(rows, [])
    assert resample.resample(docs.limit(0), target).count() == 0


def test_long_texts_are_counted_in_portions(monkeypatch):
    monkeypatch.setattr(resample, "AT_ONCE", 5)
    texts = ["a b c d e f g h i j k l m n", None, "x y", " ".join("w" * (k % 80 + 1) for k in range(300))]
    got, n_words = Counter(), [0] * 4
    for owner, bucket, n in resample.Features(10_000).of(texts):
        got.update(zip(owner.tolist(), bucket.tolist(), strict=True))
        n_words = [a + int(b) for a, b in zip(n_words, n, strict=True)]
    words = [WORDS.findall(lower(t)) for t in texts]
    assert n_words == list(map(len, words))
    assert got == Counter((d, zlib.crc32(x.encode()) % 10_000) for d, w in enumerate(words) for x in [*w, *map(" ".join, itertools.pairwise(w))])


def test_tournament():
    rng = random.Random(9)
    rows = [rng.randbytes(resample._ROW) for _ in range(500)]
    runs = [sorted(rows[k::5]) for k in range(5)]
    blocks = sorted((b"".join(run[a : a + 7])[: resample._ROW], k, b"".join(run[a : a + 7])) for k, run in enumerate(runs) for a in range(0, 100, 7))
    assert list(resample.merged(((k, b) for _, k, b in blocks), 5, 10**9)) == sorted(rows)
    assert list(resample.merged(((k, b) for _, k, b in blocks), 8, 123)) == sorted(rows)[:123]


# the SQL of every operator that has one


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        duck.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = duck.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert Counter(map(tuple, got.select(*order).collect())) == Counter(want.select(*order).fetchall())


# ids beyond 2**53 beside nulls, in every operator with Python steps

FAR = 2**53 + 1


@pytest.mark.parametrize("name", ["lm", "quality", "minhash", "packing", "simhash", "html"])
def test_far_ids_beside_nulls(spark, name):
    words = " ".join(f"word{k}" for k in range(40))
    rows = [(FAR, words, "en", "s", 1), (None, words + " other.", "en", "s", 1), (7, "A third text. " + words[::-1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    if name == "html":
        pages = spark.createDataFrame([(d, "u", f"<p>{t}</p>") for d, t, *_ in rows], "page_id long, url string, html string").coalesce(1)
        got = [r.page_id for r in html_extract.extract(pages).collect()]
    else:
        found = {
            "lm": lambda: lm.score(docs), "minhash": lambda: minhash.near_duplicates(docs), "packing": lambda: packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")), "simhash": lambda: simhash.fingerprints(docs),
            "quality": lambda: quality.score(docs, spark.createDataFrame([(FAR, 1), (7, 0)], "doc_id long, quality int")),
        }[name]()
        got = [r.doc_id for r in found.collect()]
    assert Counter(got) == Counter([FAR, None, 7])


# 5, 6 and 9: what was left out before


def test_short_runs_are_compared(spark):
    pair = "The cat sat down here. It rained all day long."
    table = [(1, "One. " + pair), (2, pair + " Two."), (3, "Three. " + pair), (4, "The cat sat down here. Four.")]
    got = {r.doc_id: (r.text, list(r.removed)) for r in substring.dedup_spans(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got == {1: (table[0][1], []), 2: ("Two.", [0, 1]), 3: ("Three. ", [1, 2]), 4: (table[3][1], [])}


def test_short_items_are_found_whole(spark):
    bench = spark.createDataFrame([(1, "Who won it?"), (2, "a b"), (3, "Zug"), (4, "..."), (5, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "and who won, it was said"), (2, "who won that"), (3, "b a"), (4, "c a, b."), (5, "zug! zug"), (6, None), (7, "won it who")], "doc_id long, text string")
    got = {r.doc_id: list(r.item_ids) for r in decontam.flag(docs, bench).collect()}
    assert got == {1: [1], 2: [], 3: [], 4: [2], 5: [3], 6: [], 7: []}


def test_page_tokens():
    read = lambda h: list(html_extract.tokens(h))
    assert read("a<b>c</b > 1 < 2") == ["a", "<b>", "c", "</b >", " 1 ", "<", " 2"]
    assert read("<p title='>'>x<!-- <p> -->y<!-- z") == ["<p title='>'>", "x", "<!-- <p> -->", "y", "<!-- z"]
    assert read("<script src='x'/>var a = '<p>';</script>b") == ["<script src='x'/>", "b"]
    assert read("<SCRIPT>if (a<b && c>'</p>') x</Script >b") == ["<SCRIPT>", "b"]
    assert read("<svg>a<p>b") == ["<svg>", "a", "<p>", "b"] and read("<svg/>a</svg>") == ["<svg/>", "a", "</svg>"]
    assert read("<p a='>b<i>c") == ["<p a='>", "b", "<i>", "c"] and read("<style>p {}") == ["<style>"]
    assert read("x <a href") == ["x ", "<", "a href"] and read("") == []
    for piece in ("<a '", "<a ", "<a b='", "<!a", "<svg>", "<script/>", "</a"):
        began = time.time()
        html_extract.main_text(piece * 200_000, html_extract.Weights({}))
        assert time.time() - began < 20


def test_links_and_titles_of_the_article_stay():
    w = html_extract.Weights({})
    body = "<p>" + "Plain words of an article that go on for a while. " * 4 + "</p>"
    page = f"<nav><a href=/>Home</a></nav><article><h1>A title</h1>{body}<p><a href=x>The whole report</a></p>{body}<div class='related'><a>Other</a></div></article><footer>Foot</footer>"
    got = html_extract.main_text(page, w).split("\n")
    assert got[0] == "A title" and "The whole report" in got and len(got) == 4
    bare = html_extract.main_text(page.replace("article>", "div>"), w).split("\n")
    assert bare[0] == "A title" and len(bare) >= 3 and "Home" not in bare and "Foot" not in bare
