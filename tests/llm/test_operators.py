"""The training-data operators against brute force, and on awkward tables: nulls in any column,
empty and very long texts, ties and repeated rows, empty tables, extra columns with clashing names."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from asrprep.llm import (bfd_packing, bpe, components, exact_dedup, html_text, mixture_packing, ngram_lm, quality, rules,
                         simhash, toxicity)
from asrprep.llm.elias_fano import EliasFano, Trie
from asrprep.llm.exprs import crc_mod
from asrprep.llm.tokens import WordEndIds, byte_encoding, splitter, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, fp long, score double"
LONG = " ".join(f"word{i % 977} the" for i in range(30_000))


def row(i, text, source="s"):
    return (i, text, None, source, None, True, 7, 0.5)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [row(1, None), row(2, ""), row(3, " \t\n"), row(4, "The cat, the dog's 12 cats.\nThe cat"), row(5, LONG, None),
            row(6, "x" * 3000 + " ée 日本語 ̇ İ"), row(6, "x" * 3000 + " ée 日本語 ̇ İ"), row(None, "a b c d"), row(None, None),
            row(8, "The cat, the dog's 12 cats.\nThe  cat"), row(9, "a\tb\x0bc  d\x1ce \x85 f <|endoftext|>", None), row(10, "a b c d")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "source")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def test_splitter_equals_pattern():
    import public_tokenizers
    import regex

    find, want, rnd = splitter(), regex.compile(public_tokenizers.PATTERN).findall, random.Random(5)
    for _ in range(3000):
        t = "".join(chr(rnd.choice([rnd.randrange(0x260), 32, 10, 39, 115, 0x3000])) for _ in range(rnd.randrange(40)))
        assert find(t) == want(t)


def test_bpe_equals_tiktoken(awkward, empty):
    enc = byte_encoding(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"]), bytes(r["decoded"]))
                 for r in bpe.encode(awkward, with_ids=True).collect())
    want = []
    for i, t in texts_of(awkward):
        ids = enc.encode_ordinary(t)
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest(), tuple(ids), t.encode()))
    assert got == sorted(want)
    assert bpe.encode(empty).collect() == []


def test_word_end_ids_equal_tokenizers():
    words, rnd = WordEndIds.of(tokenizer_path("word_bpe_49k.json")), random.Random(3)
    for _ in range(1500):
        t = "".join(chr(rnd.choice([rnd.randrange(0x260), 32, 10, 39, 115, rnd.randrange(65, 123)])) for _ in range(rnd.randrange(50)))
        assert words.encode(t).tolist() == words.model.encode(t, add_special_tokens=False).ids


def brute_fingerprint(text):
    import xxhash

    w = [x for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, bits=3):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in itertools.combinations(sorted(parent), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash_groups(awkward, empty):
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_groups(awkward).collect()}
    fps = [(i, brute_fingerprint(t)) for i, t in texts_of(awkward)]
    root = brute_components({f for _, f in fps})
    for i, f in fps:
        assert got[(i, f"{f:016x}")] == min((j for j, g in fps if root[g] == root[f] and j is not None), default=None)
    assert simhash.near_groups(empty).collect() == []
    assert simhash.keep_one(awkward).columns == awkward.columns


@pytest.mark.parametrize("hot_cell", [1, 3, 1000])
@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_exact_with_hot_cells(spark, hot_cell, bits):
    rnd = random.Random(bits)
    values = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(12):
            v = centre
            for b in rnd.sample(range(64), rnd.randrange(5)):
                v ^= 1 << b
            values.add(v if v < 2**63 else v - 2**64)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(fps, bits, hot_cell).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= bits for a, b in edges)
    roots = {r["node"]: r["root"] for r in components.connected(simhash.links(fps, bits, hot_cell)).collect()}
    assert {v: roots.get(v, v) for v in values} == brute_components(values, bits)


def test_components_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (7, 7)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(awkward, empty, weak):
    """With a hash of two values every group must be told apart by its bytes."""
    kw = {"hash128": lambda c: F.length(c) % 2} if weak else {}
    got = sorted(str(tuple(r)) for r in exact_dedup.groups(awkward, **kw).collect())
    rows = texts_of(awkward)
    norm = {t: "".join(c for c in t if c not in " \t\n\x0b\f\r") for _, t in rows}
    want = []
    for i, t in rows:
        same = [(j, u) for j, u in rows if norm[u] == norm[t]]
        best = min((-len(u), j is None, j or 0) for j, u in same)
        keep = None if best[1] else best[2]
        want.append(str((i, keep, len(same), i == keep and len(t) == -best[0], hashlib.sha256(norm[t].encode()).hexdigest())))
    assert got == sorted(want)
    assert exact_dedup.groups(empty, **kw).collect() == []


def test_exact_keep_one(awkward):
    kept = exact_dedup.keep_one(awkward)
    assert kept.columns == awkward.columns
    norms = ["".join((r["text"] or "").split()) for r in kept.collect()]
    assert len(norms) == len(set(norms))


def brute_repeat(words):
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = collections.Counter(grams)
    return len({i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)})


def test_rules(spark, awkward, empty):
    rnd = random.Random(2)
    extra = spark.createDataFrame([row(100 + i, "".join(rnd.choice(["a ", "b ", "#", "c\n", "\n", "d\t", "The ", "É!"])
                                                        for _ in range(rnd.randrange(80)))) for i in range(200)], SCHEMA)
    docs = awkward.unionByName(extra)
    judged = rules.judge(docs.select("doc_id", "text", "kept"))
    for r in judged.collect():
        t = r["text"] or ""
        w = [x.decode() for x in t.encode().split()]
        lines = [x for x in t.split("\n") if x.encode().split()]
        assert (r["n_words"], r["word_chars"]) == (len(w), sum(map(len, w)))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == brute_repeat(w)
        assert r["base_failed"] == (len(w) < 10 or 100 * brute_repeat(w) > 20 * len(w))
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
    assert rules.keep_good(docs).count() == judged.where("kept").count()
    assert rules.keep_good(docs).columns == docs.columns and rules.judge(empty).collect() == []


def test_elias_fano_and_trie(tmp_dir):
    rng = np.random.default_rng(0)
    for n, top in ((0, 5), (1, 1), (500, 400), (500, 10**9)):
        v = np.sort(rng.integers(0, top, n))
        ef = EliasFano.of(v)
        assert ef.get(np.arange(n)).tolist() == v.tolist()
        q = rng.integers(0, top + 5, 300)
        assert ef.find(q).tolist() == np.searchsorted(v, q).tolist()
    grams = np.unique(rng.integers(0, 30, (2000, 3)), axis=0)
    values = rng.normal(size=len(grams))
    Trie.build(grams, values, 30).save(f"{tmp_dir}/t")
    trie, known = Trie.open(f"{tmp_dir}/t"), dict(zip(map(tuple, grams.tolist()), values))
    asked = rng.integers(0, 31, (3000, 3))
    asked[:, 0] %= 30
    step = np.ptp(values) / 255
    for g, v in zip(asked.tolist(), trie.find(asked)):
        assert (tuple(g) in known) == (not np.isnan(v)) and (np.isnan(v) or abs(known[tuple(g)] - v) <= step)


def test_lm(awkward, empty):
    rows = texts_of(awkward)
    tokens = [(i, t.encode().lower().split() + [b""]) for i, t in rows]
    train = [ws for i, ws in tokens if i is not None and zlib.crc32(str(i).encode()) % 5 != 1 or i is None]
    uni = collections.Counter(w for ws in train for w in ws)
    bi = collections.Counter(p for ws in train for p in zip([b"", *ws], ws))
    n, v = sum(uni.values()), len(uni)

    def p1(w):
        return (uni[w] + 0.5) / (n + 0.5 * (v + 1))

    def p2(h, w):
        m = 5 + uni[h]
        return (bi[h, w] + m * p1(w)) / (uni[h] + m) if uni[h] else p1(w)

    assert abs(sum(p2(b"the", w) for w in uni) + p2(b"the", b"\0unknown") - 1) < 1e-9
    want = sorted((str(i), len(ws), sum(uni[w] > 0 for w in ws), n, sum(math.log10(p1(w)) for w in ws),
                   sum(math.log10(p2(h, w)) for h, w in zip([b"", *ws], ws))) for i, ws in tokens)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                 for r in ngram_lm.score(awkward, crc_mod("doc_id", 5) != 1).collect())
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 and abs(a[5] - b[5]) < 0.03 * a[1]
    assert ngram_lm.score(empty, F.lit(True)).collect() == []


def test_mixture_packing(awkward, empty):
    words = WordEndIds.of(tokenizer_path("word_bpe_49k.json"))
    ids = collections.defaultdict(list)
    for i, t in texts_of(awkward):
        ids[i].append(words.model.encode(t, add_special_tokens=False).ids + [2])
    pieces = mixture_packing.pack(awkward, length=64).collect()
    seq = collections.defaultdict(list)
    for p in pieces:
        seq[p["sequence_id"]].append((p["offset"], p["length"]))
        assert any(len(x) == p["doc_tokens"] and zlib.crc32(np.array(x[p["start"]:p["start"] + p["length"]], "<u4").tobytes())
                   == p["ids_crc32"] for x in ids[p["doc_id"]])
    for s in seq.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at == 64 or at.bit_count() == 1 and at < 64
    have = collections.Counter(p["doc_id"] for p in pieces for _ in range(p["length"]))
    assert have == {i: sum(map(len, x)) for i, x in ids.items()}
    assert mixture_packing.pack(empty).collect() == []


def test_added_tokens_as_the_library_has_them():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    plain, words = Tokenizer.from_file(path), WordEndIds.of(path)
    assert words.encode("a <|endoftext|> b").tolist() == [320, 49407, 321]
    for t in ("a <|endoftext|> b", "<|startoftext|>A b<|ENDOFTEXT|>", "x<|endoftext|><|endoftext|>é", "a <| b |>", "<|endoftext|"):
        assert words.encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("targets", [None, {"a": 0.6, "b": 0.2, "c": 0.2}])
def test_mixture_of_a_table_sorted_by_source(spark, targets):
    n = {"a": 600, "b": 300, "c": 300}
    docs = spark.createDataFrame([row(f"{s}{i}", "a b c d e", s) for s in n for i in range(n[s])],
                                 SCHEMA.replace("doc_id long", "doc_id string")).repartitionByRange(3, "source")
    assert all(len(p) == 1 for p in docs.select("source").rdd.glom().map(set).collect() if p)
    share = targets or {s: n[s] / sum(n.values()) for s in n}
    windows = collections.defaultdict(collections.Counter)
    for p in mixture_packing.pack(docs, length=120, targets=targets).collect():
        windows[p["sequence_id"]][p["source"]] += p["length"]
    assert sum(sum(w.values()) for w in windows.values()) == 6 * sum(n.values())
    first = max(i for i in windows) + 1 if targets is None else 40  # other targets: while the queues last
    full = [w for i, w in sorted(windows.items())[:first] if sum(w.values()) == 120]
    assert len(full) > 20 and all(abs(w[s] / 120 - share[s]) <= 0.1 for w in full for s in n)


def test_mixture_packing_groups_hold_no_ids(spark, awkward):
    """What is brought together for a group are numbers of its documents, however long those are."""
    plan = mixture_packing.pack(awkward, length=64)._jdf.queryExecution().optimizedPlan()
    groups = [plan]
    while groups and not groups[0].nodeName().startswith("FlatMapCoGroupsIn"):
        node = groups.pop(0)
        groups += [node.children().apply(k) for k in range(node.children().size())]
    sides = [groups[0].children().apply(k).schema().simpleString() for k in range(2)]
    assert all("binary" not in side and "ids" not in side for side in sides), sides


def test_round_robin_keeps_shares():
    left, share = np.array([50_000, 30_000, 20_000]), np.array([0.5, 0.3, 0.2])
    takes, deficit = mixture_packing.round_robin(left, share, np.zeros(3), [100] * 1000)
    got = collections.Counter((w, s) for w, s, _, t in takes for _ in range(t))
    assert all(abs(got[w, s] - 100 * share[s]) <= 1 for w in range(1000) for s in range(3)) and np.abs(deficit).max() < 1e-6


def test_best_fit(awkward, empty):
    sizes = [random.Random(1).randrange(1, 100) for _ in range(500)]
    room, want = [], 0
    for s in sorted(sizes, reverse=True):  # plain best fit decreasing
        fit = [r for r in range(len(room)) if room[r] >= s]
        if fit:
            room[min(fit, key=lambda r: room[r])] -= s
        else:
            room.append(100 - s)
    packed = bfd_packing.best_fit(sizes, 100)
    assert len(packed) == len(room) and sorted(k for r in packed for k in r) == list(range(500))
    assert all(sum(sizes[k] for k in r) <= 100 for r in packed)
    enc, got = byte_encoding(tokenizer_path("byte_bpe_50k.tiktoken")), collections.defaultdict(list)
    for r in bfd_packing.pack(awkward, length=128).collect():
        m = bfd_packing.id_matrix([r["ids"]], 128)[0]
        assert r["position_resets"] == r["cu_seqlens"][:-1] and r["n_tokens"] == r["cu_seqlens"][-1]
        for i, s, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            got[i].append((s, m[a:b].tolist()))
    for i, t in texts_of(awkward):
        want = enc.encode_ordinary(t) + [bfd_packing.END_ID]
        assert {(s, tuple(want[s:s + 128])) for s in range(0, len(want), 128)} <= {(s, tuple(x)) for s, x in got[i]}
    assert bfd_packing.pack(empty).collect() == []


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain &amp; text", "plain & text"),
    ("<html><head><title>t</title><script>var a='<p>x</p>';</script></head><body><nav><a href=/>home</a></nav><div class=\"ad\">buy"
     "<article><h1>A &lt;b&gt;</h1><p><b>one  two<br>three<p>x<!-- <p>no</p> --><aside>side</aside><p>last</article><footer>f</footer>",
     "A <b>\none two three\nx\nlast"),
    ("<body><ul><li><a href=a>menu one</a><li><a href=b>menu two</a></ul><div><p>" + "long text " * 20 + "</p><p>Short.</p></div>"
     "<div id=comments><p>" + "reader comment " * 20 + "</p></div></body>", ("long text " * 20).strip() + "\nShort."),
    ("<main><form>f<input></form><p>in&nbsp;main\n\n text</p><div style='display: none'>h</div></main>", "in main text"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


BODY = "body text without links " * 20


@pytest.mark.parametrize("attrs", ["class=has-sidebar", "id='content-with-comments'", 'class="post-body tags-news"', "id=related-work",
                                   "class=widget", "title='hidden costs'", "data-id=ad"])
def test_names_do_not_drop_the_text(attrs):
    div = f"<div {attrs}><p>{BODY}</p><p>Short end.</p></div>"
    for page in (f"<body><ul><li><a href=a>menu</a></ul>{div}</body>", f"<article>{div}</article>"):
        assert html_text.main_text(page) == BODY.strip() + "\nShort end."


@pytest.mark.parametrize("name", ["comments", "comment-list", "post-comments", "ad", "cookieBanner", "widget", "sidebar-inner"])
def test_names_drop_what_is_no_denser(name):
    side = f"<div class={name}><p>{BODY[:-100]}</p></div>"
    assert html_text.main_text(f"<body><div><p>{BODY}</p></div>{side}</body>") == BODY.strip()
    assert html_text.main_text(f"<article><p>{BODY}</p>{side}</article>") == BODY.strip()


@pytest.mark.parametrize("page,text", [
    ("<p>one</p><svg class=i /><p>two</p>", "one\ntwo"), ("<p>one <svg/>more <math/>text</p><svg><text>x</text></svg>", "one more text"),
    ("<svg-icon></svg-icon><p>two</p>", "two"), ("<title-bar><p>one</p></title-bar><template-x>two</template-x>", "one\ntwo"),
    ("<p>one</p><iframe src=x><p>two</p>", "one\ntwo"), ("<p>one</p><svg a='x>y'><title>t</title></svg ><p>two</p>", "one\ntwo"),
    ("<p>one</p><script>var a='<p>x</p>'", "one"), ("<p>one</p><!-- two <p>x</p>", "one"),
    ("<p>one</p><script src='a>var a</script><p>two</p>", "one\ntwo"), ("<SCRIPT>a</scripty>b</Script\n><p>two</p></svg>", "two")])
def test_raw_elements_end_where_they_end(page, text):
    assert html_text.main_text(f"<main>{page}") == text


ADVERTS = "<div class=ad><p>buy</p><p>this</p><p>now</p></div>"


@pytest.mark.parametrize("page,text", [
    (f"<body><div><p>{BODY}</p>{ADVERTS}<p>Closing.</p></div>{ADVERTS}<section><p>Imprint.</p></section></body>", f"{BODY}\nClosing."),
    (f"<body><p>Opening.</p>{ADVERTS}<p>{BODY}</p>{ADVERTS}<ul><li>One</li></ul>{ADVERTS}<p>Closing.</p></body>",
     f"Opening.\n{BODY}\nOne\nClosing."),
    (f"<body><div><div>{BODY}</div>{ADVERTS}<div>Closing.</div></div></body>", f"{BODY}\nClosing."),
    (f"<main><h1>Title</h1></main><div><p>{BODY * 2}</p>{ADVERTS}<p>Closing.</p></div>{ADVERTS}<section><p>Imprint.</p></section>",
     f"Title\n{BODY * 2}\nClosing."),
    (f"<main><h1>Title</h1>{ADVERTS}<section><p>Short.</p></section></main><div><p>{BODY}</p></div>", "Title\nShort."),
    (f"<main></main><div><p>{BODY}</p></div>", BODY)])
def test_windows_choose_the_text(page, text):
    assert html_text.main_text(page) == text.replace(" \n", "\n").strip()


COMMENT = "<article class=comment><p>reader comment</p></article>"


@pytest.mark.parametrize("page,text", [
    (f"<body><article><p>Main.</p><div class=comments>{COMMENT}</div></article></body>", "Main."),
    (f"<body><article><p>Main.</p></article><div class=comments>{COMMENT}{COMMENT}</div></body>", "Main."),
    (f"<body><article><p>Main.</p>{COMMENT}</article>{COMMENT}<article id=related-posts><p>More</p></article></body>", "Main."),
    ("<body><aside><article><p>Teaser</p></article></aside><article class='post related'><p>Main.</p></article></body>", "Main."),
    (f"<body><div><p>{BODY}</p></div><div id=comments>{COMMENT}</div></body>", BODY.strip()),
    ("<body><div id=page><div class=ad>buy<article><p>Main.</p></article></div></body>", "Main."),
    ("<body><form id=aspnet><article><p>Main.</p></article></form></body>", "Main."),
    ("<body><main><article class=comment-policy><p>Main.</p></article><article class=post><p>Second.</p></article></main></body>",
     "Main.\nSecond."),
    ("<body><div class='page sidebar'><article><p>Main.</p></article></div></body>", "Main.")])
def test_articles_in_noise(page, text):
    assert html_text.main_text(page) == text


def test_extract_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>", "old"), (1, "u", "<p>x</p>", "old"), (None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), ("x", 1), ("x", 1)]
    assert html_text.extract(pages.limit(0)).collect() == []


def labelled(spark, marks, n=600):
    rnd = random.Random(11)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7))) for _ in range(rnd.randrange(15, 60))]
        docs.append(row(i, marks(rnd, w, bad)))
        labels.append((i, int(bad)))
    docs += [row(None, None), row(n, "")]
    return spark.createDataFrame(docs, SCHEMA), labels


def held_out_accuracy(scored, labels, held):
    want = dict(labels)
    rows = [r for r in scored.collect() if r["doc_id"] in want and r["held_out"]]
    assert rows and all(r["held_out"] == held(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored.collect())
    return sum(r["predicted"] == want[r["doc_id"]] for r in rows) / len(rows)


def test_toxicity_learns(spark, empty):
    def marks(rnd, w, bad):
        if bad:
            w.insert(rnd.randrange(len(w)), "vilest" + rnd.choice(["", "en", "er", "ly"]))
        return " ".join(w)

    docs, labels = labelled(spark, marks)
    lab = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    held = crc_mod("doc_id", 5) == 0
    model = toxicity.fit(docs, lab, ~held)
    assert held_out_accuracy(toxicity.score(docs, model, held), labels, lambda i: zlib.crc32(str(i).encode()) % 5 == 0) > 0.95
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    none = toxicity.fit(docs, lab.limit(0), ~held)
    assert none is None and {r["score"] for r in toxicity.score(docs, none, held).collect()} == {0.0}
    assert toxicity.score(empty, model, held).collect() == []


def test_quality_learns_from_positives_only(spark, empty):
    docs, labels = labelled(spark, lambda rnd, w, bad: " ".join(x.upper() + "!!" if bad else x for x in w))
    good = [(i, 1 - b) for i, b in labels]
    lab = spark.createDataFrame(good, "doc_id long, quality int")
    held = crc_mod("doc_id", 3) == 1
    model = quality.fit(docs, lab.where("quality = 1"), ~held)
    assert abs(model.prior - 0.75) < 0.15
    assert held_out_accuracy(quality.score(docs, model, held), good, lambda i: zlib.crc32(str(i).encode()) % 3 == 1) > 0.95
    assert quality.fit(docs, lab.limit(0), ~held) is None
    assert quality.score(empty, None, held).collect() == []
