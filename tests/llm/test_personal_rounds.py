"""Discovered identifiers against the same rounds in plain Python; many identifiers in one text."""

import math
import random
import re
import time
from collections import defaultdict

from cases import docs_frame
from pyspark.sql import functions as F
from test_texts import brute_spans

from lodgewise.llm import personal

NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9][0-9 ().-]{5,30}[0-9](?![0-9A-Za-z])")
HANDLE = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}@[A-Za-z0-9-]{2,64}(?![A-Za-z0-9-])")


def brute_extra(texts, rounds=3, least_seeds=3, least_score=0.8):
    """For each text the discovered (start, kind, end)."""
    spans, edges = [], defaultdict(lambda: -1)
    for text in texts:
        base = [(a, k, b) for a, k, b in brute_spans(text)]
        loose = [(m.start(), -1, m.end()) for r in (NUMBER, HANDLE) for m in r.finditer(text)]
        loose = [x for x in loose if not any(x[0] < b and a < x[2] for a, _, b in base)]
        spans.append(loose)
        for a, k, b in base + loose:
            left = re.search(r"(\S+\s+\S+)\s*$", text[max(0, a - 40) : a].lower(), re.ASCII)
            right = re.search(r"^\W*(\w+\W+\w+)", text[b : b + 40].lower(), re.ASCII)
            instance = re.sub("[ ().-]", "", text[a:b].lower())
            for side, m in (("l ", left), ("r ", right)):
                if m:
                    key = side + m.group(1), instance
                    edges[key] = max(edges[key], k)
    size = defaultdict(int)
    for pattern, _ in edges:
        size[pattern] += 1
    seeds = {(i, k): 1.0 for (_, i), k in edges.items() if k >= 0}
    accepted, taken = dict(seeds), {}
    for _ in range(rounds):
        held = defaultdict(list)
        for pattern, i in edges:
            for (j, k), s in accepted.items():
                if j == i:
                    held[pattern, k].append(s)
        confidence = {pk: sum(v) / size[pk[0]] for pk, v in held.items() if len(v) >= least_seeds}
        doubt = defaultdict(float)
        for (pattern, i), own in edges.items():
            for (other, k), c in confidence.items():
                if own < 0 and other == pattern and (k == 0) == ("@" in i) and k != 1:
                    doubt[i, k] += math.log1p(-min(c, 0.999))
        best = {}
        for (i, k), d in doubt.items():
            best[i] = max(best.get(i, (0, 0)), (1 - math.exp(d), -k))
        taken = {i: (-k, s) for i, (s, k) in best.items() if s >= least_score}
        accepted = dict(seeds)
        for i, (k, s) in taken.items():
            accepted[i, k] = max(s, accepted.get((i, k), 0))
    out = []
    for text, loose in zip(texts, spans, strict=True):
        found = {(a, taken[i][0], b) for a, _, b in loose if (i := re.sub("[ ().-]", "", text[a:b].lower())) in taken}
        out.append(sorted(found))
    return out


def extras(spark, texts):
    rows = personal.find_personal(docs_frame(spark, list(enumerate(texts)))).collect()
    return [sorted(set(map(tuple, r["all"])) - set(map(tuple, r["base"]))) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_second_hop(spark):
    """Phones teach `call me`, numbers behind it teach `my desk`, which no phone ever stood behind."""
    texts = [f"please call me +4930{i:02d}5551{i:02d}7 soon then" for i in range(12)]
    texts += [f"please call me 555 0{i}2 77{i} soon then" for i in range(6)]
    texts += [f"now at my desk 555 0{i}2 77{i} all day" for i in range(6)]
    texts += ["now at my desk 700 123 456 all day", "the sum was 700 999 456 in all"]
    first, found = extras_of_rounds(spark, texts, 1), extras(spark, texts)
    assert found == brute_extra(texts)
    assert len(found[24]) == 1 and not first[24] and not found[25]


def extras_of_rounds(spark, texts, rounds):
    found = personal.extract(docs_frame(spark, list(enumerate(texts))))
    got = {r.doc_id: sorted(map(tuple, r.extra)) for r in personal.discovered(found, rounds).collect()}
    return [got.get(i, []) for i in range(len(texts))]


def test_rounds_equal_plain_python(spark):
    rng = random.Random(11)
    kinds = [
        lambda: f"+49 {rng.randint(100, 999)} {rng.randint(1000000, 9999999)}", lambda: f"u{rng.randint(0, 9)}@mail{rng.randint(0, 3)}.example",
        lambda: f"{rng.randint(100, 999)} {rng.randint(100, 999)} {rng.randint(0, 3)}00", lambda: f"u{rng.randint(0, 9)}@host{rng.randint(0, 3)}", lambda: "10.0.0.7",
    ]
    leads = [["call me at", "dial now the"], ["write to me", "ÄRGER über das"], ["call me at", "the sum of"], ["write to me"], ["dial now the"]]
    texts = []
    for _ in range(150):
        some = [0, 0, 0, 1, 1, 1, 2, 3, 4]
        own = [(rng.choice(leads[k]), kinds[k](), ["or else then", "thank you all", "or else then", "thank you all", "日本 x y"][k]) for k in rng.choices(some, k=rng.randint(0, 3))]
        texts.append(" ".join(map(" ".join, own)))
    assert extras(spark, texts) == brute_extra(texts) and any(brute_extra(texts))


def test_many_identifiers_in_one_text(spark):
    n = 8_000
    text = " ".join(f"né {i}: u{i}@a{i % 7}.example, tel +49 30 {5550000 + i} und 10.0.{i % 256}.{i % 200}; 555 {i:06d} x" for i in range(n))
    docs = docs_frame(spark, [(1, text), (2, "a@b.c")])
    start = time.time()
    got = {r.doc_id: r for r in personal.report(docs).collect()}
    redacted = {r.doc_id: r for r in personal.redact(docs).collect()}
    assert time.time() - start < 120
    assert (got[1].n_email, got[1].n_phone, got[1].n_ip) == (n, n, n)
    lines = redacted[1].text.split("; ")
    assert lines[0] == "né 0: [EMAIL], tel [PHONE] und [IP]" and text.split("; ")[-1] in redacted[1].text.split("; ")[-1] or "[" in redacted[1].text
    assert redacted[1].text.count("[EMAIL]") == redacted[1].text.count("[IP]") == n and redacted[2].text == "[EMAIL]"


def test_running_sums_and_cuts(spark):
    rng = random.Random(2)
    values = [[rng.randint(0, 50) for _ in range(n)] for n in (0, 1, 2, 3, 10, 47, 300)]
    df = spark.createDataFrame([(v,) for v in values], "v array<int>")
    for r in df.select("v", personal._running(F.col("v")).alias("s"), personal._running(F.col("v"), most=True).alias("m"), F.transform(F.array(*[F.lit(x) for x in (-1, 0, 7, 99)]), lambda x: personal._below(F.array_sort("v"), x)).alias("b")).collect():
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v))] and r.m == [max([0, *r.v[:i]]) for i in range(len(r.v))]
        assert r.b == [sum(x < y for x in r.v) for y in (-1, 0, 7, 99)]
    text = "".join(rng.choice("aé日🙂\n") for _ in range(5000))
    spans = [tuple(sorted(rng.sample(range(5001), 2))) for _ in range(60)] + [(0, 0), (5000, 5000), (0, 5000), (1023, 1024), (1024, 2048), (1024, 1025)]
    one = spark.createDataFrame([(text, a, b) for a, b in spans], "t string, a int, b int")
    assert all(r.c == text[r.a : r.b] for r in one.select("a", "b", personal._cut(personal._chunks(F.col("t")), F.col("a"), F.col("b")).alias("c")).collect())
