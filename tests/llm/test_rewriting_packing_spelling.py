"""Fill-in-middle, packing and spelling variants against plain versions, on tables of the driver and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from commitloom.llm import fill_in_middle, packing, queries, spelling

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n long, form string, near string, sequence_id long, row string"
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, null ids, repeats, a long text, code points of every width; extra columns named like the operators' own."""
    texts = [None, "", "a", "<P>", "x <S", "S>y <|endoftext|> Ünïcode  𝄞\r\n\x00\t end", "word " * 9000, "same text here", "same text here", "é" * 5000]
    rows = [(i if i != 7 else 8, t, i, "f", "w", i, "r") for i, t in enumerate(texts)] + [(None, "no id", 0, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def middle_by_hand(doc_id, text, seed="1"):
    text = text or ""
    g = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(g[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_fill_in_middle(request, which):
    table = request.getfixturevalue(which)
    want = sorted(((r.doc_id, *middle_by_hand(r.doc_id, r.text)) for r in table.collect()), key=repr)
    out = fill_in_middle.transform(table)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fill_in_middle.digests(out).collect()}
    texts = {(r.doc_id, sha(middle_by_hand(r.doc_id, r.text)[-1]), sha(r.text)) for r in table.collect()}
    assert got == texts


def test_fill_in_middle_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op11_fill_in_middle"]).fetchall()
    assert sorted(map(tuple, queries.op11_fill_in_middle(spark, DATA).collect()), key=repr) == sorted(want, key=repr)


def test_offsets_count_code_points_of_long_texts():
    for text in ("", "𝄞", "a\r\nb" * 40_000, "é" * 333):
        o = fill_in_middle.Offsets(text)
        assert o.n == len(text) and all(o[r] == r for r in {0, o.n, *random.Random(5).sample(range(o.n + 1), min(30, o.n + 1))})


def best_fit(histogram, limit):
    """Largest piece first, then always the largest that fits."""
    left, bins = dict(histogram), 0
    while left:
        room = limit
        for k in sorted(left, reverse=True):
            n = min(left[k], room // k)
            room -= n * k
            left[k] -= n
        left = {k: n for k, n in left.items() if n}
        bins += 1
    return bins


def check_plan(histogram, limit):
    made = packing.plan(histogram, limit)
    entries = sorted(zip(made.length, made.first, made.base, made.offset, strict=True))
    placed = {}
    for k, n in histogram.items():
        own = [e[1:] for e in entries if e[0] == k]
        assert own[0][0] == 0
        for (first, base, offset), last in zip(own, [e[0] for e in own[1:]] + [n], strict=True):
            for at in range(last - first):
                placed.setdefault(base + at, []).append((offset, k))
    assert sorted(placed) == list(range(made.sequences)) and made.sequences >= made.lower_bound
    for parts in placed.values():
        assert [o for o, _ in sorted(parts)] == list(itertools.accumulate([0] + [k for _, k in sorted(parts)]))[:-1]
        assert sum(k for _, k in parts) <= limit
    assert Counter(k for parts in placed.values() for _, k in parts) == histogram
    return made


def fewest(pieces, limit):
    """By trying everything."""
    best = [len(pieces)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] + pieces[i] <= limit:
                go(i + 1, [*bins[:k], bins[k] + pieces[i], *bins[k + 1 :]])
        go(i + 1, [*bins, pieces[i]])

    go(0, [])
    return best[0]


def test_small_plans_are_nearly_optimal():
    draw = random.Random(3)
    extra = 0
    for _ in range(25):
        pieces = sorted((draw.randint(1, 12) for _ in range(11)), reverse=True)
        extra += check_plan(dict(Counter(pieces)), 20).sequences - fewest(pieces, 20)
    assert extra <= 2


@pytest.mark.parametrize("times", [1, 1000])
def test_plans_beat_or_meet_best_fit(times, monkeypatch):
    """As good on a thousand times as many pieces, with as many steps."""
    monkeypatch.setattr(packing, "STEPS", 1024)
    draw = np.random.default_rng(7)
    mixed = Counter(np.minimum(4096, draw.lognormal(6.5, 1.1, 2000).astype(int) + 1).tolist())
    middle = Counter(draw.integers(700, 1400, 3000).tolist())
    few = {2049: 500, 2047: 300, 1366: 400, 1365: 800, 700: 10}
    hot = {1300: 5_000} | dict(Counter(draw.integers(100, 300, 500).tolist()))
    for histogram, slack in ((mixed, 1.005), (middle, 1.0), (few, 1.0), (hot, 1.005)):
        scaled = {int(k): int(n) * times for k, n in histogram.items()}
        made = packing.plan(scaled) if times > 1 else check_plan(scaled, 4096)
        assert made.sequences <= times * (slack * best_fit(histogram, 4096) + 1)
        assert len(made.length) < 60_000


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_places_every_token(request, spark, which, monkeypatch):
    monkeypatch.setattr(packing, "SALTED", 20)
    table = request.getfixturevalue(which)
    library = Tokenizer.from_file(WORDS)
    want = Counter()
    for r in table.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[r.doc_id, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = packing.pack_documents(table, WORDS, 1).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate([0] + [n for _, n in parts]))[:-1] and sum(n for _, n in parts) <= 4096
    total = sum(n for _, _, _, n, _ in want.elements())
    assert len(by) <= best_fit(Counter(n for _, _, _, n, _ in want.elements()), 4096) + 1 and len(by) >= total / 4096


def test_packed_sequences_hold_all_ids(docs):
    pieces = packing.tokenised(docs, WORDS, 1, limit=512)
    want = Counter(i for r in pieces.collect() for i in np.frombuffer(r.ids, "<u4").tolist())
    got = packing.sequences(pieces, 512).collect()
    assert Counter(i for r in got for i in np.frombuffer(r.ids, "<u4").tolist()) == want and max(len(r.ids) for r in got) <= 4 * 512


def test_words_of_the_map_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 40)
    monkeypatch.setattr(packing, "STRETCH", 64)
    with open(WORDS, encoding="utf-8") as f:
        encoder, library = packing.Encoder(f.read()), Tokenizer.from_file(WORDS)
    assert encoder.split
    for text in ("don't, (Éa)x! naïveа ÀÖØö×÷ÿ ẞß ǅ a<|b |> [x] ¡qué! 3rd é́", "it's  O'Neil'S　x́ ́y", "a\x1cb\x85c \x0b\x0c <|startoftext|>z <|ENDOFTEXT|>", " ".join(f"W{i}é İstanbul" for i in range(200)), "\n\n \n", "é ﬁ Ⅷ ２３ 你好 한국어"):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(rows, slip=31):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if slip and h % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    n = {w: k for w, k in total.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) if (vs := near[w]) else None for w in n}
    form = {w: f if f and n[f] >= 10 * n[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def test_variants_of_documents(spark, docs):
    rows = docs.orderBy("doc_id").limit(60)
    got = spelling.group_variants(spelling.vocabulary(rows, slip=31)).collect()
    assert {tuple(r) for r in got} == variants_by_hand([(r.doc_id, r.text) for r in rows.collect()]) and len(got) > 300


def test_variants_of_odd_rows(spark, odd, monkeypatch):
    """Chains of forms, ties, accents, capitals, doubled letters, a long run; a filter so full that it lets much pass."""
    monkeypatch.setattr(spelling, "BITS", 4)
    monkeypatch.setattr(spelling, "HELD", 3)
    text = "Éclairss " * 2 + "Éclairs " * 30 + "éclairs " * 2 + "ÉclairX " * 400 + "aaaaaaaa " * 2 + "aaaaaaa " * 2 + "bookkeeper " * 20 + "bookeeper " * 2 + "bookkeepers " * 2 + "z" * 300 + " " + "z" * 300 + " " + "z" * 299 + "y "
    rows = [(1, text), (1, text), (None, text), (2, None), (3, "")] + [(r.doc_id, r.text) for r in odd.collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for slip in (31, None):
        got = spelling.group_variants(spelling.vocabulary(table, slip=slip)).collect()
        assert len(got) == len({r.word for r in got}) and {tuple(r) for r in got} == variants_by_hand(rows, slip)


def test_neighbours_are_distinct_and_complete():
    letters = "abé"
    for word in ("aab", "abab", "bbbb", "éa"):
        codes = np.array([word], f"<U{len(word)}").view(np.uint32).reshape(1, -1)
        found = [str(w) for _, part in spelling.neighbours(codes, np.array(sorted(map(ord, letters)), np.uint32), lambda h: np.arange(len(h))) for w in part]
        want = {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i + k :] for i in range(len(word) + 1) for c in letters for k in ((0, 1) if i < len(word) else (0,))}
        assert sorted(found) == sorted(want - {word})


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert fill_in_middle.transform(none).isEmpty() and packing.pack_documents(none, WORDS, 1).isEmpty() and spelling.group_variants(spelling.vocabulary(none)).isEmpty()


def test_ids_may_be_strings(spark):
    table = spark.createDataFrame([("k", "letters letters", 1)], "doc_id string, text string, x int")
    assert fill_in_middle.transform(table).first().n == 15 and packing.pack_documents(table, WORDS, 1).first().doc_id == "k"
    assert spelling.vocabulary(table, slip=31).first().word.startswith("lette")
