"""Operators of the training-data pipeline against plain versions, on small
tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import collections
import hashlib
import itertools
import math
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import (
    chat_repair, common, decontaminate, hpy_model, line_runs, near_duplicates, quality_ledger, secret_scan,
    sentencepiece_codec, spelling_variants, toxicity, url_rules,
)
from ledgerlake.llm.queries import URL_RULES, tokenizer_file

SHARED = "This line is shared by many documents and is quite long."
BASE = " ".join(f"w{i}" for i in range(120))
ITEM = "Which river runs through the old town of the seven bridges today. It is the quiet green Amber."
TEXTS = [
    None, "", "   \n\t ", SHARED, SHARED + "\nown line", "x\n  " + SHARED.upper() + " \n" + SHARED, SHARED + "\n" + BASE,
    SHARED, BASE, BASE.replace("w5 ", "v5 "), BASE, BASE.replace("w50 ", "v50 ").replace("w90 ", "u "),
    'a password = "abcdef12" token=a:password=xyz123 AKIA' + "A" * 16 + " " + "0123456789abcdef" * 2,
    "pwd: Xq9$vLr2!kWz and pwd: password1 login is qwerty1234", "some words " * 40, "é ß 门 😀\n" * 30,
    ("lead in words here " * 5) + ITEM + " tail words", "plain talk " + ITEM[:30], "long " * 20000,
]
ROWS = [(None if i == 7 else i % 17, t, i) for i, t in enumerate(TEXTS)]  # a null id and two repeated ones


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, kept int").withColumn(
        "h", F.lit(1)).withColumn("_drops", F.lit("x")).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("kept < 0")


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_secret_spans(docs, nothing):
    got = rows_of(secret_scan.scan(docs, tokenizer_file("word_bpe_49k.json")), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for d, t, _ in ROWS:
        t = t or ""
        spans = [("assign", m) for m in re.finditer(
            r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t, re.A) if len(m[1]) >= 6]
        n = len(spans), *[0] * 2
        a = [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        x = [("hex", m) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        n = len(spans), len(a), len(x)
        order = sorted(spans + a + x, key=lambda s: (s[1].start(), ("assign", "access", "hex").index(s[0])))
        want.append((d, *n, hashlib.sha256(",".join(f"{k}:{m.start()}:{m.end()}" for k, m in order).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs, tokenizer_file("word_bpe_49k.json")).collect()}
    assert spans[13].count("guess:") == 1  # the random value, not the word and not the keyboard walk
    assert secret_scan.scan(nothing, tokenizer_file("word_bpe_49k.json")).count() == 0


def plain_guess_cost(value, words):
    """The cheapest segmentation, from the definitions: every substring is
    priced as every kind that it is."""
    sc, log = secret_scan, math.log10
    rows = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
    at = {c: (r, i) for r, row in enumerate(rows) for i, c in enumerate(row)}

    def price(s):
        low = s.lower()
        brute = sum(sc._alphabet_cost(c) for c in s)
        out = [brute]
        leet = low.translate(str.maketrans("430157$@!", "aeoistsai"))
        if len(s) >= 3 and low in words:
            out.append(log(words[low] + 1) + sc._case_cost(s))
        elif len(s) >= 3 and leet in words:
            out.append(log(words[leet] + 1) + sc._case_cost(s) + sum(a != b for a, b in zip(low, leet)) * log(2))
        for k, pattern in enumerate(sc._DATES):
            if m := pattern.fullmatch(s):
                out.append(log(120 * (365 if k < 3 else 1)) + (log(4) if k < 3 and m[1] else 0))
        for p in range(1, len(s) // 2 + 1):
            if len(s) >= 3 and len(s) % p == 0 and s == s[:p] * (len(s) // p):
                unit = sum(sc._alphabet_cost(c) for c in s[:p])
                if low[:p] in words:
                    unit = min(unit, log(words[low[:p]] + 1))
                out.append(unit + log(2) + (len(s) // p - 2) * sc.COPY)
        if len(s) >= 4 and all(c in at for c in low):
            ways = [(at[b][0] - at[a][0], at[b][1] - at[a][1]) for a, b in zip(low, low[1:])]
            if all(w in {(0, -1), (0, 1), (-1, 0), (-1, 1), (1, -1), (1, 0)} for w in ways):
                turns = 1 + sum(a != b for a, b in zip(ways, ways[1:]))
                out.append(log(47) + len(s) * sc.WALK_KEY + turns * log(4.6) + sum(c.isupper() for c in s) * log(2))
        return min(out)

    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min(best[i] + sc.SEGMENT_COST + price(value[i:j]) for i in range(j)))
    return best[-1]


def test_guess_cost_is_the_cheapest_segmentation():
    words = {"pass": 3, "word": 9, "password": 1, "yellow": 40, "aba": 7, "wer": 11}
    rng = np.random.default_rng(8)
    values = ["password1", "passwordpass", "aaaaaaaa", "qwertyui", "qwertyellow", "2019-03-04", "12112019", "Zk3", "pa55word", "aa",
              "xyabcabcabcab", "PaSsQwErT", "İqwer", "yellowyellowyellow", "asdfdsasdf", "12342019"]
    for letters in ("aab", "qwer", "qwErty1", "0129", "pasword5", "abyelow"):
        values += ["".join(rng.choice(list(letters), rng.integers(1, 15))) for _ in range(150)]
    for value in values:
        assert secret_scan.guess_cost(value, words, 8) == pytest.approx(plain_guess_cost(value, words)), value
    assert secret_scan.guess_cost("password", words, 8) < secret_scan.guess_cost("Xq9$vLr2", words, 8)
    assert secret_scan.guess_cost("qw" * 20_000, words, 8) < 100  # long values stay cheap to price


def plain_lines(rows, least=5):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = collections.defaultdict(list)
    for i, (d, t, _) in enumerate(rows):
        for k in {key(s) for s in (t or "").split("\n")}:
            if len(k) >= 40:
                held[k].append(d)
    out = []
    for d, t, _ in rows:
        kept = []
        for s in (t or "").split("\n"):
            ids = held.get(key(s), [])
            last = max((x for x in ids if x is not None), default=None)
            if not (len(ids) >= least and last is not None and (d is None or d < last)):
                kept.append(s)
        out.append((d, len((t or "").split("\n")), len((t or "").split("\n")) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(docs, nothing):
    want = sorted([(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain_lines(ROWS)], key=repr)
    assert rows_of(line_runs.line_digests(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
    assert sum(w[2] for w in want) >= 5
    back = line_runs.deduplicate(docs)
    assert back.columns == docs.columns
    assert rows_of(back, "doc_id", F.coalesce("text", F.lit(""))) == sorted([(d, t) for d, _, _, t in plain_lines(ROWS)], key=repr)
    assert line_runs.line_digests(nothing).count() == 0


def test_line_runs_hold_each_hash_once(spark, docs):
    runs = line_runs.LineRuns(spark)
    for batch in line_runs.in_batches(docs.select("doc_id", "text")):
        runs.add(batch)
    fresh = runs.read().filter("fresh")
    assert fresh.count() == fresh.select("h").distinct().count() == runs.merged().count()
    assert len(runs.levels[0]) < line_runs.FAN_IN


def test_chat_repair_is_cheapest(spark):
    rows, roles = [], [None, "user", "assistant", "system", "tool"]
    cases = list(itertools.product(roles, repeat=3))
    for c, case in enumerate(cases):
        rows += [(None if c == 3 else c, t if t else None, r, None if t == 1 else f"t{t}", 9) for t, r in enumerate(case)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seg int")
    got = chat_repair.repair(df).toPandas()
    assert len(got) == len(rows)

    def legal(seq):
        state = chat_repair.NONE
        for r in seq:
            if r not in chat_repair.NEXT[state]:
                return False
            state = r
        return state == 2

    def cheapest(case):
        best = 99.0
        for new in itertools.product(range(3), repeat=len(case)):
            label = sum(0 if chat_repair.role_number(o) == r else (.5 if chat_repair.role_number(o) is None else 2) for o, r in zip(case, new))
            for merge in itertools.product((0, 1), repeat=len(case) - 1):
                if any(m and new[i] != new[i + 1] for i, m in enumerate(merge)):
                    continue
                turns = [new[0]] + [r for r, m in zip(new[1:], merge) if not m]
                for extra in range(5):
                    if any(legal(s) for s in fill(tuple(turns), extra)):
                        best = min(best, label + sum(merge) + 3 * extra)
                        break
        return best

    memo = {}

    def fill(turns, extra):
        if (turns, extra) not in memo:
            memo[turns, extra] = {turns} if not extra else {
                s[:i] + (r,) + s[i:] for s in fill(turns, extra - 1) for i in range(len(s) + 1) for r in range(3)}
        return memo[turns, extra]

    cost = lambda role, new, action, n: (0 if role == new else (.5 if role not in chat_repair.ROLES else 2)) + ("merge" in action) + 3 * n
    for c in (0, 7, 31, 44, 62, 93, 124):
        part = got[got.conv_id == c].sort_values(["seg", "pos"])
        paid = sum(cost(r.role, r.new_role, r.action, r.n_inserted) for r in part.itertuples())
        assert paid == cheapest(cases[c]), cases[c]
        text = "".join(part.piece)
        order = [chat_repair.ROLES.index(x) for x in re.findall(r"<\|(system|user|assistant)\|>", text)]
        assert legal(order) and text.count("<|end|>") == len(order)
    assert chat_repair.repair(df.filter("seg = 0")).count() == 0


def test_chat_order_does_not_depend_on_the_split(spark):
    """Turns that differ only after the head keep their order in any row order."""
    rows = [(1, 1, "user", "x" * 70 + c) for c in "dbac"] + [(1, 2, "assistant", "fine")]
    made = []
    for part in (rows, rows[::-1]):
        got = chat_repair.repair(spark.createDataFrame(part, "conv_id long, turn long, role string, text string")).toPandas()
        made.append("".join(got.sort_values(["seg", "pos"]).piece))
    assert made[0] == made[1] and all("x" * 70 + c in made[0] for c in "abcd")


def test_sentencepiece_matches_the_library(docs, nothing):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    want = []
    for d, t, _ in ROWS:
        ids = lib.encode(t or "", add_eos=True)
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert rows_of(sentencepiece_codec.encode_digests(docs, path)) == sorted(want, key=repr)
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, path), path)
    assert rows_of(back) == sorted([(d, lib.decode(lib.encode(t or ""))) for d, t, _ in ROWS], key=repr)
    assert sentencepiece_codec.encode_digests(nothing, path).count() == 0
    codec = sentencepiece_codec.Codec(sentencepiece_codec.Pieces(path))
    rng = np.random.default_rng(1)
    parts = ["a", "in", " ", "  ", "\n", "é", "门", "😀", "▁", "the", "\x00", "aaa"]
    for _ in range(500):
        t = "".join(rng.choice(parts, rng.integers(0, 20)))
        ids = lib.encode(t, add_eos=True)
        assert codec.encode(t) == ids, repr(t)
        assert codec.digest(t) == (len(ids), " ".join(map(str, ids)), lib.decode(ids)), repr(t)
    pieces = list(codec.p.id)
    for a, b in zip(rng.choice(pieces, 5000), rng.choice(pieces, 5000)):  # edges decide as merging does
        assert codec._compatible(a, b) == (sentencepiece_codec.merged(a + b, codec.p.score) == [a, b])


def test_clashing_and_dotted_column_names(spark):
    """Extra columns with names that the operators use themselves, with dots
    and back-quotes, pass through as they are."""
    rows = [(d, t, f"x{i}", i, None, f"z{i}") for i, (d, t, _) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _drop_id string, `a.b` int, `c``d` string, row string")
    lines = line_runs.deduplicate(docs)
    assert lines.columns == docs.columns
    assert sorted(r[3] for r in lines.collect()) == list(range(len(rows)))
    assert {r[3]: r[2] for r in lines.collect()} == {r[3]: r[2] for r in rows}
    kept = near_duplicates.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}
    items = spark.createDataFrame([("q1", ITEM), (None, None)], "item_id string, text string")
    found = decontaminate.hits(docs, items).collect()
    assert found and {r["item_id"] for r in found} == {"q1"}


def test_toxicity(spark, docs, nothing):
    bad, good = ["dreadfool", "vilescum"], ["lovely", "garden", "river", "calm", "stone", "table"]
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(good, 40)) + (" " + bad[i % 4 // 2] if i % 2 else ""), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.score(df.select("doc_id", "text"), df.select("doc_id", "toxic")).toPandas()
    held = got[got.held_out]
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    assert (held.predicted == held.doc_id % 2).mean() > 0.95
    more = spark.createDataFrame([(1, "you dreadfoool"), (2, "calm garden"), (3, None), (4, "")], "doc_id long, text string")
    p = {r["doc_id"]: r["score"] for r in toxicity.score(more.unionByName(df.select("doc_id", "text")), df).collect()[:4]}
    assert p[1] > 0.3 > p[2] and p[3] == p[4]
    assert toxicity.score(docs, df.select("doc_id", "toxic").filter("toxic > 1")).agg(F.max("score")).first()[0] < 1e-6
    assert toxicity.score(nothing, df).count() == 0


@pytest.mark.parametrize("size, pct", [(3, 85), (5, 80)])
def test_near_duplicates(docs, nothing, size, pct):
    sets = [near_duplicates.word_set(t, size) for _, t, _ in ROWS]
    comp = list(range(len(ROWS)))
    for i, j in itertools.combinations(range(len(ROWS)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
            comp = [comp[i] if c == comp[j] else c for c in comp]
    want = []
    for i, (d, _, _) in enumerate(ROWS):
        ids = [ROWS[j][0] for j in range(len(ROWS)) if comp[j] == comp[i] and ROWS[j][0] is not None]
        least = (min(ids) if ids else None) if sets[i] else d
        want.append((d, len(sets[i]), least, d == least))
    assert rows_of(near_duplicates.classify(docs, size, pct)) == sorted(want, key=repr)
    stay = near_duplicates.distinct_documents(docs, size, pct)
    assert stay.columns == docs.columns
    groups = {comp[i] for i in range(len(ROWS)) if sets[i]}
    assert stay.count() == len(groups) + sum(not s for s in sets)
    assert near_duplicates.classify(nothing, size, pct).count() == 0


def test_many_near_copies(spark):
    """A group of edited copies and a passage that many different texts share."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        w = [f"b{k}" for k in range(100)]
        for k in rng.integers(0, 100, rng.integers(0, 7)):
            w[k] = f"e{i}_{k}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(200 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(int(rng.integers(5, 40))))) for i in range(150)]
    sets = [near_duplicates.word_set(t, 3) for _, t in rows]
    comp = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            comp = [comp[i] if c == comp[j] else c for c in comp]
    least = {c: min(rows[j][0] for j in range(len(rows)) if comp[j] == c) for c in set(comp)}
    got = near_duplicates.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: least[comp[i]] for i, (d, _) in enumerate(rows)}


def test_url_rules(spark):
    urls = ["http://example.org/es/x", "https://a.EXAMPLE.org/en/12?q", "x://b.org", "http://c.org/", "http://d.com/fr/1",
            "http://d.com/de/1#f", "nourl", None, "", "http://a.com:80/fr/", "http://org/", "ftp://x.net/a://b.org/"]
    df = spark.createDataFrame([(i % 10, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = url_rules.judge(df, spark.createDataFrame(URL_RULES, "rule string, verdict string"))

    def plain(u):
        host = path = ""
        if u and "://" in u:
            host = re.split("[/?#]", u.split("://", 1)[1])[0]
            path = re.split("[?#]", u.split("://", 1)[1][len(host):])[0]
            host = host.lower()
        fit = [(len(r), r, v) for r, v in URL_RULES
               if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        return (host, path, *(max(fit)[1:] if fit else (None, "allow")))

    assert rows_of(got) == sorted([(i % 10, *plain(u)) for i, u in enumerate(urls)], key=repr)
    assert url_rules.judge(df.filter("page_id < 0"), spark.createDataFrame(URL_RULES, "rule string, verdict string")).count() == 0


def test_quality_ledger(docs, nothing):
    got = rows_of(quality_ledger.ledger(docs), "doc_id", *quality_ledger.MEASURES)
    want = []
    for d, t, _ in ROWS:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [s for s in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
        at = collections.defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i:i + 8])].append(i)
        again = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(again)))
    assert got == sorted(want, key=repr)
    kept = quality_ledger.keep(docs)
    rows = quality_ledger.ledger(docs)
    assert kept.columns == docs.columns
    assert kept.count() == rows.filter(~quality_ledger.rejects(F.col("failed_rules"))).count() > 0
    table = {r["rule"]: r for r in quality_ledger.ablation(rows).collect()}
    bits = [r["failed_rules"] for r in rows.collect()]
    assert table["few_words"]["n_only"] == sum(b & quality_ledger.mask(2) == 1 for b in bits)
    assert quality_ledger.ledger(nothing).count() == quality_ledger.keep(nothing).count() == 0


def test_hpy_scores(spark, docs, nothing):
    got = hpy_model.score(docs).collect()
    counts = collections.Counter()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    for d, t, _ in ROWS:
        if not held(d):
            counts.update((t or "").encode().lower().split() + [b" "])
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t, _ in ROWS:
        w = (t or "").encode().lower().split() + [b" "]
        want.append((d, held(d), len(w), sum(counts[x] > 0 for x in w), n,
                     round(sum(np.log10((counts[x] + .1) / (n + .1 * (v + 1))) for x in w), 4)))
    assert sorted(((*r[:5], round(r["base_score"], 4)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["score"] < 0 for r in got)
    assert hpy_model.score(nothing).count() == 0


def test_hpy_word_context_reaches_the_score(spark):
    """The same words score better in an order that the training texts hold, and
    the two-word restaurants grow with the texts."""
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10][:60]
    a, b = "alpha river stone cloud tree lamp", "lamp cloud alpha tree stone river"
    rows = [(i, a) for i in train] + [(held[0], a), (held[1], b)]
    got = {r["doc_id"]: r for r in hpy_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]]["score"] > got[held[1]]["score"] + 3
    assert got[held[0]]["base_score"] == pytest.approx(got[held[1]]["base_score"])

    rng, sizes = np.random.default_rng(4), []
    for n in (20, 80):
        texts = [(train[i % 60], " ".join(rng.choice([f"w{k}" for k in range(400)], 50))) for i in range(n)]
        asked = hpy_model.requests(hpy_model.chunked(spark.createDataFrame(texts, "doc_id long, text string")))
        model, n_all, _ = hpy_model.fit_words(asked)
        sizes.append(model.select("u", "v").distinct().count())
        assert n_all == n * 51 and model.filter("p <= 0 OR p >= 1").count() == 0
    assert sizes[1] > 3 * sizes[0]


def test_hpy_triples_travel_packed(spark, monkeypatch):
    """Packed triples take few bytes a token, no stage but the scores is left, and
    words dealt to several shares give the counts, and nearly the scores, of whole ones."""
    rng = np.random.default_rng(5)
    odds = 1 / np.arange(1, 301)
    texts = [(i, " ".join(f"w{k}" for k in rng.choice(300, 100, p=odds / odds.sum()))) for i in range(300)] + [(None, None), (0, "w1 New")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    asked = hpy_model.requests(hpy_model.chunked(frame))
    rows = asked.packed.filter("share >= 0")
    n_bytes = rows.selectExpr("sum(length(keys) + length(body))").first()[0]
    assert n_bytes < 12 * 101 * 300 and not len(asked.hot)
    assert asked.packed.filter("share < 0").count() == len(texts)

    made = []
    folder = hpy_model.stage_folder
    monkeypatch.setattr(common, "stage_folder", lambda *a: made.append(folder(*a)) or made[-1])
    monkeypatch.setattr(hpy_model, "stage_folder", common.stage_folder)
    runs = []
    for deal in (hpy_model.DEAL_ROWS, 3000):
        monkeypatch.setattr(hpy_model, "DEAL_ROWS", deal)
        runs.append(sorted((tuple(r) for r in hpy_model.score(frame).collect()), key=repr))
    assert len(hpy_model.requests(hpy_model.chunked(frame)).hot) > 1
    left = [f for f in made[:made.index(next(x for x in made[1:] if "lm-texts" in x))] if os.path.exists(f.removeprefix("file:"))]
    assert {f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in left} <= {"lm-texts", "lm-scores"}
    whole, split = runs
    assert [r[:5] for r in whole] == [r[:5] for r in split]
    assert [r[5] for r in whole] == pytest.approx([r[5] for r in split])
    total = [sum(r[6] for r in run) for run in runs]
    assert total[1] == pytest.approx(total[0], rel=0.02)
    assert np.corrcoef([r[6] for r in whole], [r[6] for r in split])[0, 1] > 0.97


def test_hpy_predictions_sum_to_one():
    """After any seating the probabilities of all symbols after a context sum to one."""
    rng = np.random.default_rng(0)
    first = [(s, w, float(rng.integers(0, 4))) for s in range(5) for w in range(1, 258, 7)]
    upper = hpy_model.upper_levels(first)
    assert upper.sum(1) == pytest.approx(np.ones(258), abs=1e-9)
    context = (3 << 27) | (9 << 18) | (4 << 9) | 7
    key = np.sort(np.array([(context << 9) | w for w in range(1, 258)], np.int64))
    n = rng.integers(0, 50, len(key))
    trees = hpy_model.Subtrees(key, n, upper, rng)
    for _ in range(3):
        trees.sweep()
    assert trees.predictions()[4].sum() == pytest.approx(1)
    assert ((trees.t[4] >= (n > 0)) & (trees.t[4] <= n)).all()


def test_seating_follows_the_exact_law():
    """Three customers of one dish: the draws' table counts against the exact conditional."""
    d, theta, base, others = 0.5, 1.0, 0.4, 2.0
    new = lambda t: (theta + d * (others + t)) * base
    ways = {1: (1 - d) * (2 - d) * new(0), 2: 3 * (1 - d) * new(0) * new(1), 3: new(0) * new(1) * new(2)}
    n = 40000
    old, hpy_model.PROPOSALS = hpy_model.PROPOSALS, 8
    rng = np.random.default_rng(5)
    # One restaurant a dish; the other dishes' tables are put in as a second dish.
    c = np.r_[np.full(n, 3.0), np.full(n, 2.0)]
    t = np.r_[np.ones(n), np.full(n, 2.0)]
    room = np.r_[np.arange(n), np.arange(n)]
    disc, conc = hpy_model.DISCOUNT, hpy_model.CONCENTRATION
    hpy_model.DISCOUNT, hpy_model.CONCENTRATION = (d,) * 5, (theta,) * 5
    out = hpy_model.reseat(c, t, room, np.full(2 * n, base), 1, rng)[:n]
    hpy_model.PROPOSALS, hpy_model.DISCOUNT, hpy_model.CONCENTRATION = old, disc, conc
    for k, w in ways.items():
        assert (out == k).mean() == pytest.approx(w / sum(ways.values()), abs=0.02)


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame([(1, ITEM, 5), (2, None, 5), (3, "", 5), (None, "Never seen anywhere at all. Nowhere.", 5)],
                                  "item_id long, text string, score int")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.hits(docs, items).collect()} == {(16, 1)}
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 1
    assert decontaminate.hits(docs, items.filter("item_id > 9")).count() == 0
    assert decontaminate.hits(nothing, items).count() == 0


def test_decontamination_with_glued_signs_and_cut_answers(spark):
    """A sign glued to the last word, quotes around words, and a passage cut
    before its short last sentence still are leaks; other texts are not."""
    passage = " ".join(f"word{i}" for i in range(36))
    item = passage + ". Only for."
    lead, tail = "lead in text here " * 4, " and more text behind"
    texts = [lead + item + tail, lead + item + "&&&" + tail, lead + passage + tail,
             lead + " ".join(f"“{w}”," for w in item.split()) + tail, lead + "only for." + tail,
             lead + " ".join(passage.split()[:12]) + " only for." + tail]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "... !!")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.hits(docs, items).collect()) == [(i, 1) for i in range(4)]
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, items).collect()) == [4, 5]


def test_retrieval_equals_plain_bm25(spark):
    """Every unit at or above the threshold, by scoring all units of all passages."""
    rng = np.random.default_rng(2)
    words = [f"k{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(40)]
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 300)))) for _ in range(60)]
    rows = decontaminate.postings(spark.createDataFrame(items, "item_id long, text string")).collect()
    ix = decontaminate.shard_index([(r["item"], r["unit"], bytes(r["term"]), r["impact"]) for r in rows],
                                   {r["item"]: (r["item_id"], r["text"]) for r in rows})
    got = {(d, ix.items[i][0]): s for d, i, s in decontaminate.retrieve(ix, [decontaminate.words_of(t) for t in texts], 0.6)}
    impact = collections.defaultdict(dict)
    for r in rows:
        impact[r["item_id"]][bytes(r["term"])] = r["impact"]
    want = {}
    for d, t in enumerate(texts):
        w = decontaminate.words_of(t)
        for at in range(0, len(w) + 1, decontaminate.STRIDE):
            seen = set(w[at:at + 2 * decontaminate.STRIDE])
            for i, terms in impact.items():
                s = sum(v for k, v in terms.items() if k in seen)
                if s >= 0.6:
                    want[d, i] = max(s, want.get((d, i), 0))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got) and got


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="testdata not present")
def test_pipeline_runs_through(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert 0 < out.count() < docs.count()
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def plain_near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if x == y or len(y) - len(x) > 1:
        return False
    i = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return x[i + 1:] == y[i + 1:] if len(x) == len(y) else x[i:] == y[i + 1:]


def test_composition_accepts_each_near_pair_once():
    rng = np.random.default_rng(3)
    for _ in range(200):
        words = sorted({"".join(rng.choice(list("abé"), rng.choice([3, 4]))) for _ in range(rng.integers(1, 40))})
        short = [w for w in words if len(w) == 3]
        both = spelling_variants.Acceptors()
        p, q = both.add(short), both.add(words)
        want = [(x, y) for x in short for y in words if plain_near(x, y) and (len(y) > len(x) or x < y)]
        assert sorted(both.one_edit(p, q)) == sorted(want)


def plain_variants(rows, every):
    n = collections.Counter()
    for d, t, *_ in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: sorted((x for x in n if plain_near(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: near[w][0] if near[w] and n[near[w][0]] >= 5 * n[w] else None for w in n}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def test_spelling_variants(spark, docs, nothing):
    rng = np.random.default_rng(5)
    base = ["abcdef", "éabcdeß", "walking", "Talking", "÷×abcd"]
    texts = [None, "", "short ab", "walking " * 3000, f"{'ab' * 2500} {'ab' * 2500}c {'ba' + 'ab' * 2499} " * 40]
    for _ in range(300):  # edits of edits, repeated, in upper case, at both ends
        w = list(base[rng.integers(len(base))])
        for _ in range(rng.integers(0, 4)):
            at, kind = rng.integers(0, len(w)), rng.integers(3)
            w[at:at + (kind > 0)] = [] if kind == 2 else [str(rng.choice(list("abÀz")))]
        texts.append(" ".join(["".join(w)] * int(rng.choice([1, 5, 6, 40]))) + ",AbCdEf 12")
    rows = [(None if i % 50 == 7 else i // 2, t, "x") for i, t in enumerate(texts)]  # null and repeated ids
    table = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    for every, block in ((199, 4096), (3, 4)):  # small blocks: initial states dealt out again
        got = rows_of(spelling_variants.group_variants(table, every=every, block_words=block))
        want = plain_variants(rows, every)
        assert got == want
        assert len({w[2] for w in want}) < len(want) and max(w[4] for w in want) > 3
    assert spelling_variants.group_variants(nothing).count() == 0


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(20)] + [("v", "w07")]
    got = dict(rows_of(spelling_variants.roots(spark.createDataFrame(chain, "word string, form string"))))
    assert set(got.values()) == {"w20"} and len(got) == 21
