"""The text operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from jobtide.llm import registered
from jobtide.llm.bpe import Codec, read_ranks
from jobtide.llm.components import connected_components
from jobtide.llm.jaccard import jaccard_groups
from jobtide.llm.language import marginals
from jobtide.llm.language_model import DEPTH, score_texts
from jobtide.llm.mixing import mix_sources
from jobtide.llm.near_vectors import calibrated, near_vectors
from jobtide.llm.personal import fit_spans, personal_spans, propose
from jobtide.llm.substrings import repeated_passages
from tests.oracle import compare, connect

SF01 = "/root/testdata/sf0.01"


def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def held_out(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus == 2


def groups_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1200)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    expected = groups_of({n for link in links for n in link if link[0] != link[1]}, links)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got.keys() == expected.keys()
    assert len({(got[n], expected[n]) for n in got}) == len(set(expected.values())) == len(set(got.values()))


@pytest.mark.parametrize("weights", [None, {"a": 5.0, "b": 3.0, "c": 1.0, None: 1.0}])
def test_mixing(spark, weights):
    sizes = {"a": 700, "b": 100, "c": 410, None: 33}
    rows = [(k * 10 + j, name) for j, (name, n) in enumerate(sizes.items()) for k in range(n)]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_rows=4, period=20).collect()
    assert sorted((r.doc_id, str(r.source)) for r in out) == sorted((d, str(s)) for d, s in rows)
    slots = {r.mix_slot: (str(r.source), r.mix_block) for r in out}
    blocks = {(s, b) for s, b in slots.values()}
    assert sorted(slots) == list(range(len(slots))) and len(blocks) == len(slots)
    left = {s: sum(b[0] == s for b in blocks) for s in {b[0] for b in blocks}}
    share, done, slot = {str(r.source): r.mix_share for r in out}, Counter(), 0
    while slot < len(slots):  # period by period: earliest deadline first, by simulation
        now = {s: min(share[s], n) for s, n in left.items() if n}
        total, had = sum(now.values()), Counter()
        for t in range(total):
            ready = [(-(-(had[s] + 1) * total // c), f"={s}" if s != "None" else "unknown", s) for s, c in now.items() if had[s] < c and had[s] * total // c <= t]
            s = min(ready)[2]
            assert slots[slot] == (s, done[s])
            had[s], done[s], slot = had[s] + 1, done[s] + 1, slot + 1
            assert all(abs(had[s] - c * (t + 1) / total) < 1 for s, c in now.items())
        left = {s: n - now.get(s, 0) for s, n in left.items()}


def naive_tree(train, depth):
    """Context-tree weighting by its definition, with a dictionary of counts for each context and bit prefix."""
    counts, longer = Counter(), defaultdict(set)
    for text in train:
        data = b"\0" * depth + text + b"\xff"
        for at in range(depth, len(data)):
            for bit in range(8):
                prefix, value = (bit, data[at] >> (8 - bit)), data[at] >> (7 - bit) & 1
                for d in range(depth + 1):
                    context = data[at - d : at]
                    counts[context, prefix, value] += 1
                    if d:
                        longer[context[1:], prefix].add(context)

    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    known = {}

    def log(context, prefix):
        if (context, prefix) not in known:
            own = kt(counts[context, prefix, 0], counts[context, prefix, 1])
            if len(context) < depth:
                own = np.logaddexp(own, sum(log(c, prefix) for c in longer[context, prefix])) - math.log(2)
            known[context, prefix] = own
        return known[context, prefix]

    def estimate(data, at, d, prefix, value):
        context = data[at - d : at]
        zeros, ones = counts[context, prefix, 0], counts[context, prefix, 1]
        if not zeros + ones:
            return None
        own = ((ones if value else zeros) + 0.5) / (zeros + ones + 1)
        deeper = estimate(data, at, d + 1, prefix, value) if d < depth else None
        if deeper is None:
            return own
        stay = math.exp(kt(zeros, ones) - math.log(2) - log(context, prefix))
        return stay * own + (1 - stay) * deeper

    def score(text):
        data = b"\0" * depth + text + b"\xff"
        return sum(
            math.log10(estimate(data, at, 0, (bit, data[at] >> (8 - bit)), data[at] >> (7 - bit) & 1) or 0.5)
            for at in range(depth, len(data)) for bit in range(8)
        )

    return score


def test_context_tree(spark):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice(("An", "the ", "ea", "\n", "é", "Q")) for _ in range(rng.randrange(25)))) for k in range(40)]
    out = score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 3 > 0).collect()
    lower = {k: re.sub("[A-Z]", lambda m: m.group().lower(), t).encode() for k, t in rows}
    score = naive_tree([t for k, t in lower.items() if k % 3], DEPTH)
    words = {k: [w for w in re.split(rb"[\x20\x09-\x0D]+", t) if w] + [b"<end>"] for k, t in lower.items()}
    seen = Counter(w for k, ws in words.items() if k % 3 for w in ws)
    total, kinds = sum(seen.values()), len(seen)
    for r in out:
        assert r.score == pytest.approx(score(lower[r.doc_id]), rel=1e-5)
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 1) / (total + kinds + 1)) for w in words[r.doc_id]))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words[r.doc_id]), sum(seen[w] > 0 for w in words[r.doc_id]), total)


def test_passages(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passages = [fresh(52) for _ in range(6)]
    rows, expected = [], set()
    for k in range(60):
        text = fresh(150)
        if k % 3 == 0:
            text = f"{fresh(rng.randrange(30))} {passages[k % 6 + k % 2]} {text}"
            expected.add(k)
        rows.append((k, text))
    out = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in out} == expected
    by_id = dict(rows)
    assert all(any(by_id[r.doc_id][r.start : r.end].strip() in p or p in by_id[r.doc_id][r.start : r.end] for p in passages) for r in out)


def test_short_and_uniform_passages(spark):
    """Hundreds of passages of just over 50 words, each in two texts, and stretches of one word at shifted places."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passages = [fresh(51 + k % 10) for k in range(400)] + [" ".join([word()] * 120) for _ in range(20)]
    rows = [(k, f"{fresh(1 + rng.randrange(40))} {passages[k // 2]} {fresh(40)}") for k in range(2 * len(passages))]
    out = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = dict(rows)
    whole = {r.doc_id for r in out if passages[r.doc_id // 2] in by_id[r.doc_id][r.start : r.end]}
    assert whole >= set(range(800))
    # Shifted against itself a uniform stretch agrees too, so less than a chunk may be missing at an end.
    most = {r.doc_id for r in out if passages[r.doc_id // 2][96:-96] in by_id[r.doc_id][r.start : r.end]}
    assert most == set(by_id)
    assert all(len(by_id[r.doc_id][r.start : r.end].split()) == r.words for r in out)


def shingle_groups(docs, size, percent):
    sets = {}
    for k, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        sets[k] = {tuple(words[at : at + size]) for at in range(max(1, len(words) - size + 1))} if words else set()
    where = defaultdict(list)
    for k, shingles in sets.items():
        for s in shingles:
            where[s].append(k)
    links = []
    for k, shingles in sets.items():
        common = Counter(j for s in shingles for j in where[s] if j > k)
        links += [(k, j) for j, n in common.items() if 100 * n >= percent * (len(shingles) + len(sets[j]) - n)]
    roots = groups_of(sets, links)
    return {k: (len(sets[k]), roots[k]) for k in sets}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard(spark, sf, size, percent):
    docs = texts(spark, sf)
    base = max(docs.values(), key=lambda t: len(t) if len(t) < 3000 else 0).split()
    rng = random.Random(11)
    for k in range(60):  # a group of near copies at various distances, and short texts about the threshold
        words = list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(40)}"
        docs[100_000 + k] = " ".join(words)
        docs[200_000 + k] = " ".join(f"v{j}" for j in range(rng.randrange(9, 13))) + " x" * (k % 2)
    out = jaccard_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), size=size, percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == shingle_groups(docs, size, percent)


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + at % 2) for at, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for code, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if valid():
                out.append((m.start(), code, m.end(), kind))
    return sorted(out)


def test_personal(spark, sf, tmp_path):
    docs = texts(spark, SF01)
    rng = random.Random(2)
    tricky = ["a.b@c", "a@b@c.d", "x@y.zz_q@r.st", "1.2.3.4.5.6.7.8", "001.2.3.256", "+1 (201) 555-0123 4539578763621486", "9" * 6000, "1 " * 5000, "a.b" * 3000 + "@c" + ".d" * 3000]
    for k in range(200):
        docs[10**6 + k] = "".join(rng.choice(["a", "@", ".", "1", "4539578763621486", " ", "-", "+", "é🙂", "10.1.2.3", "(", ")", "x@y.com"]) for _ in range(40))
    docs |= {2 * 10**6 + k: t for k, t in enumerate(tricky)}
    spark.createDataFrame([(k, t) for k, t in docs.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    added = 0
    for r in registered.op5_personal(spark, str(tmp_path)).collect():
        expected = base_spans(docs[r.doc_id])
        listed = [f"{kind}:{start}:{end}" for start, _, end, kind in expected]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), docs[r.doc_id][:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in expected) for kind in BASE_PATTERNS]
        spans = [s for s in r.spans.split(",") if s]
        assert set(listed) <= set(spans)
        added += len(spans) - len(listed)
    assert added


def test_personal_forms_beyond_the_base(spark):
    """Addresses with words for signs and announced national numbers are found in a table full of other number runs."""
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows, wanted = [], {}
    for k in range(400):
        national = f"{number(3)} {number(3)}-{number(4)}"
        hidden = f"jo{number(2)} [at] host{number(2)} [dot] org"
        text = f"write to {hidden} or call {national} and lo{number(2)}@host.org or +1 ({number(3)}) {number(3)}-{number(4)} end"
        rows.append((k, text))
        wanted[k] = {(0, text.index(hidden), text.index(hidden) + len(hidden)), (3, text.index(national), text.index(national) + len(national))}
    rows += [(k, " x ".join(number(14) for _ in range(60))) for k in range(400, 800)]
    rows += [(k, f"host 10.0.0.{k % 250} and 10.0.{k}.300 x") for k in range(800, 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: {(s.kind, s.start, s.end) for s in r.spans} for r in personal_spans(docs, carry=["doc_id"]).collect()}
    assert sum(wanted[k] <= out[k] for k in wanted) >= 0.95 * len(wanted)


def test_span_thresholds_of_rare_kinds(spark):
    """A kind of few candidates is in the sample and has a threshold, however many candidates other kinds have."""
    rng = random.Random(6)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [(k, k, "row", " x ".join(number(14) for _ in range(60))) for k in range(200)]
    rows += [(k, k, "row", f"server 10.0.0.{k % 250} or 10.0.{k}.300 x") for k in range(200, 260)]
    proposed = propose(spark.createDataFrame(rows, "rid long, id long, row string, text string")).cache()
    assert 1 in fit_spans(proposed, max_candidates=400).thresholds


def test_exact(spark, sf):
    ok, note = compare(spark, connect(sf), "op6", registered.op6_exact_dedup, registered.SQL["op6_exact_dedup"], sf)
    assert ok, note


def test_marginals():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 1, 64, 65, 200])
    emission, start, move = rng.normal(0, 3, (lengths.sum(), 3)), rng.normal(size=3), rng.normal(0, 2, (3, 3))
    got, begin = marginals(emission, lengths, start, move), 0
    for n in lengths[lengths > 0]:
        own = emission[begin : begin + n]
        forward, backward = [start + own[0]], [np.zeros(3)]
        for at in range(1, n):
            forward.append(np.logaddexp.reduce(forward[-1][:, None] + move, 0) + own[at])
            backward.append(np.logaddexp.reduce(move + own[n - at] + backward[-1], 1))
        both = np.array(forward) + np.array(backward[::-1])
        assert np.allclose(got[begin : begin + n], np.exp(both - np.logaddexp.reduce(both, 1, keepdims=True)))
        begin += n


def test_language(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    out = [r for r in registered.op7_language(spark, SF01).collect()]
    assert all(r.held_out == held_out(r.doc_id, 4) and 0 <= r.score <= 1 for r in out)
    right = [r.lang_pred == truth[r.doc_id] for r in out if r.held_out]
    assert sum(right) >= 0.97 * len(right)


def test_bpe(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = read_ranks(path)
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    samples = ["", " ", "  \n\n x  ", "aaaa" * 50, " " * 333 + "b", "\x1c\x1d x\x1fy \x85 z q", "<|endoftext|>", "abab" * 400, "theandingion" * 60]
    samples += ["".join(rng.choice("ab ct\n.eh'Th1é—") for _ in range(rng.randint(1, 300))) for _ in range(100)]
    samples += ["".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(200)) for _ in range(30)]
    codec = Codec(ranks, pattern)
    ids, counts = codec.encode(samples)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [reference.encode_ordinary(t) for t in samples]
    assert codec.decode(ids, counts) == [t.encode() for t in samples]
    docs = texts(spark, SF01)
    for r in registered.op8_bpe(spark, SF01).collect():
        own = np.array(reference.encode_ordinary(docs[r.doc_id]), "<u4")
        assert r.n_tokens == len(own) and r.ids_sha256 == hashlib.sha256(own.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_quality(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    out = [r for r in registered.op9_quality(spark, SF01).collect()]
    assert all(r.predicted == (r.score >= 0.7) and r.held_out == held_out(r.doc_id, 4) for r in out)
    right = [r.predicted == truth[r.doc_id] for r in out if r.held_out and r.doc_id in truth]
    assert len(right) > 50 and sum(right) >= 0.95 * len(right)


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    rows = []
    for k in range(1500):
        # The first centre has a third of all; noise puts pairs on either side of the threshold.
        x = centres[0 if k % 3 == 0 else rng.integers(60)] * rng.uniform(0.5, 2) + rng.normal(0, rng.uniform(0.02, 0.2), 16)
        rows.append((k, x.tolist(), int(k % 2)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    out = {r.vec_id: r for r in near_vectors(df).collect()}
    found = np.array([out[k].n_links for k in range(len(rows))])
    assert (found <= linked.sum(1)).all() and found.sum() >= 0.99 * linked.sum()
    roots = groups_of(range(len(rows)), [tuple(p) for p in np.argwhere(linked)])
    assert np.mean([out[k].component_id == roots[k] for k in roots]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())
    assert calibrated(0.98, 24, 0.995)[1] < 24


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF01).collect()}
    scores = {r.doc_id: r.predicted for r in registered.op9_quality(spark, SF01).collect()}
    assert kept == {k for k, p in scores.items() if p}
    exact = {r.doc_id for r in corpus_pipeline.exact_copies(spark, docs, SF01).collect()}
    best = {}
    for k, r in sorted(rows.items()):
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        if key not in best or len(r.text) > len(rows[best[key]].text):
            best[key] = k
    assert exact == set(best.values())
    near = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SF01).collect()}
    assert near == {root for _, root in shingle_groups({k: r.text for k, r in rows.items()}, 5, 80).values()}
    path = str(tmp_path / "mixed")
    corpus_pipeline.mix(spark, docs, SF01).write.parquet(path)
    mixed = spark.read.parquet(path)
    assert mixed.columns == docs.columns and sorted(mixed.collect()) == sorted(docs.collect())
    order = [r.doc_id for r in mix_sources(docs).orderBy("mix_slot", "mix_rank").collect()]
    out = corpus_pipeline.tokens(spark, mixed, SF01).collect()
    assert [r.doc_id for r in sorted(out, key=lambda r: r.position)] == order
    assert all(r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest() for r in out)
    final = corpus_pipeline.run(spark, SF01).collect()
    assert {r.doc_id for r in final} <= kept & exact and sorted(r.position for r in final) == list(range(len(final)))
