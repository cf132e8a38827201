"""Known values and invariants of operators on small hand-made tables."""

import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lexigrid.functions import request as q
from lexigrid.functions.arrays import prefix_starts, struct_of_arrays
from lexigrid.operators import concordance as c
from lexigrid.operators import freq
from lexigrid.operators import match as m
from lexigrid.operators import requests as r
from lexigrid.operators import responses as rs
from lexigrid.operators.phrases import phrase_search, relocate
from lexigrid.plans.scale import running_offsets, salted_join, top_per_group
from lexigrid.sources.calls import calls_of, read_calls
from lexigrid.sources.corpus import load_corpus, with_tokens
from lexigrid.sources import responses as src

CALL = "call_id bigint, call_type string, params map<string,array<string>>"


def call(spark, params, call_type="Collx"):
    as_lists = {k: v if isinstance(v, list) else [str(v)] for k, v in params.items()}
    return spark.createDataFrame([(0, call_type, as_lists)], CALL)


@pytest.mark.parametrize(
    "params, key",
    [
        ({"q": 'alemma,"bird"', "corpname": "susanne"}, "26d29b1b39a77ab48f0f53a00a6aa736"),
        ({"q": 'alemma,"dog"', "corpname": "susanne"}, "246e9b78ffcfd750f7f2e9a2a0a3aa27"),
        ({"q": 'alemma,"bird"', "corpname": "susanne", "format": "csv"}, "9cf98dbe4fe7d735ba79a97b1cbc569c"),
        ({"q": 'alemma,"bird"', "corpname": "susanne", "format": "txt"}, "57274b193187873b0214500a47bcb813"),
        ({"q": 'alemma,"bird"', "corpname": "susanne", "format": "xml"}, "111f7991212b34b9a7100289bbc7a922"),
        ({"corpname": "susanne"}, "9c08055"),
        ({"corpname": "susanne", "struct_attr_stats": 1}, "9c28c7a"),
        ({"q": 'alemma,"apple"', "corpname": " susanne "}, "bc5d89b"),
    ],
)
def test_known_keys(spark, params, key):
    # fixed values: known keys of calls that leave the defaults out
    row = r.with_key(call(spark, params), algo="blake2b", legacy=True).first()
    assert row.key.startswith(key)


def test_known_key_of_a_view_call(spark):
    params = {"q": 'alemma,"bird"', "corpname": "susanne"}
    given = params | {"format": "json", "asyn": "0"}
    keys = {r.with_key(call(spark, p, "View"), algo="blake2b", legacy=True).first().key[:7] for p in (params, given)}
    assert keys == {"8cdfca2"}


def test_kinds_of_values_reach_the_key(spark):
    lines = [
        '{"call_type": "Collx", "q": "z", "corpname": "c"}',
        '{"call_type": "Collx", "q": ["z"], "corpname": "c"}',
        '{"call_type": "Collx", "q": "z", "corpname": "c", "x": null}',
        '{"call_type": "Collx", "q": "z", "corpname": "c", "format": "json"}',
        '{"call_type": "Collx", "q": [10, 9], "n": 1.0, "t": true, "m": 3}',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "call_id long, value string")
    calls = calls_of(df)
    keys = {x.call_id: x.key for x in r.with_key(calls).collect()}
    assert keys[0] == keys[3] and len({keys[0], keys[1], keys[2], keys[4]}) == 4
    text = {x.call_id: x.canonical for x in r.with_canonical(calls).collect()}
    assert text[1] == '{"corpname": "c", "q": ["z"]}' and text[2] == '{"corpname": "c", "q": "z", "x": null}'
    assert text[4] == '{"m": "3", "n": "1.0", "q": [9, 10], "t": "True"}'


def test_sample_sizes_beyond_64_bits(spark):
    steps = r.step_fields(call(spark, {"q": ["r250", "r" + "9" * 30]})).orderBy("step").collect()
    assert [s.sample for s in steps] == [250, None] and {s.kind for s in steps} == {"sample"}


def test_keys_tell_types_apart(spark):
    params = {"corpname": "c", "q": "q", "fcrit": "word 0"}
    keys = {r.with_key(call(spark, params, kind)).first().key for kind in ("Freqs", "Freqml", "Freqtt")}
    assert len(keys) == 3


def test_canonical_json(spark):
    params = {"b": ["z", "a"], "a": ['q"\\\n\x1fé']}
    text = r.with_canonical(call(spark, params)).first().canonical
    # stripping takes the edge blanks only
    want = {"a": 'q"\\\n\x1fé', "b": ["a", "z"]}
    assert text == json.dumps(want, sort_keys=True, ensure_ascii=False)


def test_validation(spark):
    def error(kind, params):
        return r.validate_calls(call(spark, params, kind)).first().error

    assert error("CorpInfo", {"corpname": "c"}) == ""
    assert error("Collx", {"corpname": "c"}) == "q parameter missing"
    assert error("Freqs", {"corpname": "c", "q": "q", "fcrit": ""}) == "fcrit parameter missing"
    assert error("View", {"corpname": "c", "format": "xlsx"}).endswith(": xlsx")
    assert error("Nope", {"corpname": "c"}).startswith("unknown")
    assert r.with_defaults(call(spark, {"corpname": "c"}, "View")).first().params == {
        "corpname": ["c"], "format": ["json"], "asyn": ["0"],
    }


@pytest.mark.parametrize(
    "size, fromp, most, pages",
    [
        (93, 1, 0, range(1, 11)),
        (93, 5, 0, range(5, 11)),
        (93, 2, 2, [2, 3]),
        (93, 1, 2, [1, 2]),
        (7, 1, 0, [1]),
        (0, 1, 0, []),
        (93, 11, 0, []),
        (250_000, 1, 0, range(1, 25_001)),
    ],
)
def test_pages(spark, size, fromp, most, pages):
    calls = call(spark, {"fromp": fromp, "pagesize": 10}, "View").withColumn("key", F.lit("k"))
    sizes = spark.createDataFrame([("k", size)], "key string, concsize bigint")
    got = r.expand_pages(calls, sizes, most).select("fromp").collect()
    assert sorted(x.fromp for x in got) == list(pages)


def test_redaction(spark):
    one = lambda col, text: spark.createDataFrame([(text,)], "c string").select(col).first()[0]
    base = "http://localhost:8080/run/"
    assert one(q.redact_url("c"), base + "collx?&username=J.+Doe&api_key=1234") == base + "collx"
    kept = "view?q=alemma,%22cat%22&q=r1000&q=D&corpname=susanne"
    assert one(q.redact_url("c"), base + kept + "&username=US&api_key=12#top") == base + kept + "#top"
    body = '{"x": [1, {"b": 2}], "request": {"q": ["a"], "username": "u", "api_key": "k"}}'
    assert json.loads(one(q.redact_json("c"), body)) == {"x": [1, {"b": 2}], "request": {"q": ["a"]}}
    assert one(q.redact_json("c"), '{"x": 1}') == '{"x": 1}'
    # a body beyond 1,000 characters, one that is cut off, and an encoded name
    long = json.dumps({"request": {"q": "a" * 5000, "api_key": "k"}, "z": "b" * 5000})
    assert json.loads(one(q.redact_json("c"), long)) == {"request": {"q": "a" * 5000}, "z": "b" * 5000}
    assert one(q.redact_json("c"), long[:900]) is None
    assert one(q.redact_url("c"), base + "view?api%5Fkey=S&q=%zz&user%6Eame=u") == base + "view?q=%zz"


def test_permalink(spark):
    link = c.permalink(F.lit('[lemma="work"]'), "susanne", "http://localhost:10070/#concordance?")
    assert spark.range(1).select(link).first()[0] == (
        "http://localhost:10070/#concordance?corpname=susanne&cql=%5Blemma%3D%22work%22%5D"
        "&viewmode=sen&tab=advanced&queryselector=cql&showresults=1&default_attr=lemma_lc"
    )
    assert spark.range(1).select(c.percent_encode(F.lit("a *~+/é"))).first()[0] == "a%20%2A~%2B%2F%C3%A9"


def test_frequency_measures(spark):
    """Known rows: 150,426 tokens, 12 hits, three values of known size."""
    sizes = {"A11": (2420, 7), "N08": (2293, 2), "G04": (2385, 1), "rest": (150426 - 7098, 2)}
    rows = [(v, n, h) for v, (n, h) in sizes.items()]
    matched = spark.createDataFrame(rows, "file string, n int, h int").select(
        "file",
        F.array_repeat(F.lit("x"), F.col("n")).alias("toks"),
        F.transform(
            F.filter(F.sequence(F.lit(1), F.lit(7)), lambda i: i <= F.col("h")),
            lambda i: F.struct(i.alias("pos"), (i + 1).alias("end")),
        ).alias("hits"),
    )
    got = {x.value: x for x in freq.freqs(matched, "doc.file 0", arg='"bird"').collect()}
    for value, frq, rel, reltt, fpm in [
        ("A11", 7, 3625.97107, 2892.561983, 46.534509),
        ("N08", 2, 1093.37113, 872.219799, 13.295574),
        ("G04", 1, 525.59748, 419.287212, 6.647787),
    ]:
        row = got[value]
        assert (row.frq, round(row.rel, 5), round(row.reltt, 6), round(row.fpm, 6)) == (frq, rel, reltt, fpm)
        assert (row.total_fpm, row.total_frq, row.attribute) == (79.77, 12, "doc.file")
    # invariants: items add up; relative density averages to 100 over token shares
    assert sum(x.frq for x in got.values()) == 12
    assert abs(sum(x.rel * sizes[v][0] / 150426 for v, x in got.items()) - 100) < 1e-6


def annotation_line():
    """A line that should give the known annotation of 20 tokens."""
    tokens = (
        "as/RGa/as late/RR/late as/CSA/as the/AT/the top/NN1c/top of/IO/of the/AT/the sixth/MD/sixth "
        "were/VBDR/be that/CST/that the/AT/the Birds/NN2/bird were/VBDR/be to/TO/to end/VV0v/end "
        "their/APPGh2/their victory/NN1n/victory draought/NN1n/drought as/CSA/as they/PPHS2/they"
    ).split()
    segments = []
    for token in tokens:
        word, tag, lemma = token.split("/")
        segments += [{"str": f" {word} ", "class": ""}, {"str": f"/{tag}/{lemma}", "class": "attr"}]
    return {"toknum": 23026, "Refs": ["#23026"], "Left": segments[:22], "Kwic": segments[22:24], "Right": segments[24:]}


def test_line_annotations(spark):
    body = {"Lines": [annotation_line()], "request": {"corpname": "c", "q": ["x"]}, "Desc": [{"arg": "x"}]}
    rows = spark.createDataFrame([("k", json.dumps(body))], "key string, text string")
    row = rs.annotations(rows).first()
    assert row.toknum == 23026 and row.corpus == "c" and row.refs == ["#23026"]
    pos = "RGa RR CSA AT NNc IO AT MD VBDR CST AT NN VBDR TO VVv APPGh NNn NNn CSA PPHS".split()
    assert [row.pos[str(i)] for i in range(20)] == pos
    assert row.lemma["8"] == "be" and row.lemma["11"] == "bird" and row.lemma["17"] == "drought"
    assert row.token["11"] == "Birds" and row.token["17"] == "draought"
    body["Lines"][0]["Left"][1]["str"] = "broken"
    bad = spark.createDataFrame([("k", json.dumps(body))], "key string, text string")
    assert rs.annotations(bad, strict=False).first().malformed
    with pytest.raises(Exception, match="can't split"):
        rs.annotations(bad).collect()


def test_structures_and_sizes(spark):
    def structure(name, *attributes):
        return {"name": name, "label": "", "size": "5", "attributes": [{"name": a, "size": n} for a, n in attributes]}

    body = {
        "request": {"struct_attr_stats": 1},
        "structures": [
            structure("font", ("type", 2)), structure("head", ("type", 2)), structure("par"),
            structure("doc", ("file", 64), ("n", 12), ("wordcount", 1)),
        ],
        "sizes": {f"{k}count": str(i) for i, k in enumerate("token word doc par sent".split())},
        "Blocks": [{"Line": [{"name": n}]} for n in ("doc.file", "doc.n", "doc.wordcount")],
    }
    rows = spark.createDataFrame([("k", json.dumps(body))], "key string, text string")
    assert [tuple(x)[1:] for x in rs.structures_table(rows).collect()] == [
        ("font", "type", 2), ("head", "type", 2), ("doc", "file", 64), ("doc", "n", 12), ("doc", "wordcount", 1),
    ]
    assert rs.structure_names(rows).first().structures == "token word doc par sent"
    assert [x.attribute for x in rs.text_types_list(rows).collect()] == ["doc.file", "doc.n"]
    assert [x.attribute for x in rs.text_types_list(rows, position="0").collect()] == ["doc.file 0", "doc.n 0"]
    assert rs.text_types_list(rows, ("doc.",)).count() == 0
    assert rs.text_types_list(rows, ()).count() == 3
    without = spark.createDataFrame([("k", '{"request": {}, "structures": []}')], "key string, text string")
    with pytest.raises(Exception, match="struct_attr_stats"):
        rs.structures_table(without).collect()


def test_struct_of_arrays(spark):
    schema = "r array<struct<name:string,location:struct<lon:double,lat:double>,id:int,primary:boolean>>"
    data = [([("A", (1.1, 1.2), 1, True), ("B", (2.1, 2.2), 2, None), ("C", None, 3, True)],)]
    df = spark.createDataFrame(data, schema)
    row = df.select(struct_of_arrays(F.col("r"), df.schema["r"].dataType).alias("x")).first().x
    assert row.name == ["A", "B", "C"] and row.id == [1, 2, 3] and row.primary == [True, None, True]
    nested = df.select(F.transform("r", lambda e: e["location"]).alias("l"))
    loc = nested.select(struct_of_arrays(F.col("l"), nested.schema["l"].dataType).alias("x")).first().x
    assert loc.lon == [1.1, 2.1, None] and loc.lat == [1.2, 2.2, None]


def test_kwic_text(spark):
    line = annotation_line()
    df = spark.createDataFrame([(json.dumps(line),)], "t string").select(F.from_json("t", rs.LINE).alias("l"))
    assert df.select(c.kwic_text(F.col("l.Kwic"))).first()[0] == "Birds"


# --- scale helpers ----------------------------------------------------------------


def test_running_offsets(spark):
    rng = random.Random(1)
    # most keys crowd together, some lie far away
    keys = rng.sample(range(2000), 1500) + [10**15 + i * 10**9 for i in range(50)] + [-5]
    rows = [(k, rng.randrange(5)) for k in keys]
    got = {x.k: x.offset for x in running_offsets(spark.createDataFrame(rows, "k bigint, n bigint"), "k", "n", parts=16).collect()}
    total = 0
    for k, n in sorted(rows):
        assert got[k] == total
        total += n


def test_top_per_group_and_salted_join(spark):
    rows = [("hot" if i % 3 else "cold", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    top = top_per_group(df, ["g"], [F.desc("v")], 4)
    got = sorted((x.g, x["rank"], x.v) for x in top.collect())
    want = []
    for g in ("cold", "hot"):
        best = sorted((v for k, v in rows if k == g), reverse=True)[:4]
        want += [(g, i + 1, v) for i, v in enumerate(best)]
    assert got == sorted(want)
    one = spark.createDataFrame([("hot", 1)], "g string, x int")
    assert salted_join(df, one, ["g"]).count() == 2000
    assert salted_join(df, one, ["g"], "left").filter("x is null").count() == 1000


def test_prefix_starts(spark):
    sizes = [random.Random(2).randrange(9) for _ in range(1000)]
    got = spark.createDataFrame([(sizes,)], "a array<int>").select(prefix_starts(F.col("a"), 16)).first()[0]
    assert got == [0, *itertools.accumulate(sizes[:-1])]
    empty = spark.createDataFrame([([],)], "a array<int>").select(prefix_starts(F.col("a"))).first()[0]
    assert empty == []


# --- search against brute force ----------------------------------------------------

DOCS = [
    (0, "The cat sat on the mat. The home made recipe, the homemade recipe and the home-made recipe!"),
    (1, "We saw 1,000.99% more visitors at www.example.com yesterday, the cat said."),
    (2, "the the the cat the of of cat and the of"),
    (3, ""),
    (4, "Home-made good recipe; homemade bad recipe."),
]


def tokens_of(text):
    return re.findall(r"[^\W_]+|[^\s\w]|_", text.lower())


def corpus_of(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def brute(slots, toks):
    """Hits of slots: (predicates, gap) with shortest end."""
    out = set()
    for start in range(len(toks)):
        ends = {start}
        for test, gap in slots:
            ends = {e + k + 1 for e in ends for k in range(gap + 1) if e + k < len(toks) and test(toks[e + k])}
        if ends:
            out.add((start, min(ends)))
    return out


@pytest.mark.parametrize(
    "words, gaps",
    [(["the", "of"], [0, 2]), (["the", "cat", "of"], [0, 1, 3]), (["the", "the"], [0, 1]), (["of"], [0])],
)
def test_gaps(spark, words, gaps):
    slots = [m.after_gap(m.term(w), g) if g else m.term(w) for w, g in zip(words, gaps)]
    hits = m.hit_rows(m.match(with_tokens(corpus_of(spark)), slots)).collect()
    want = set()
    for doc, text in DOCS:
        pairs = [((lambda x, w=w: x == w), g) for w, g in zip(words, gaps)]
        want |= {(doc, s, e) for s, e in brute(pairs, tokens_of(text))}
    assert {(h.doc_id, h.pos, h.end) for h in hits} == want and want


def test_phrase_search(spark):
    phrases = {1: "home--made * recipe", 2: "the cat | of", 3: "*", 4: "rec*e", 5: "home--made recipe", 6: "?he c*", 7: "THE CAT", 8: "zzz | mat."}
    table = spark.createDataFrame(list(phrases.items()), "phrase_id int, phrase string")
    got = {(x.phrase_id, x.doc_id, x.pos, x.end) for x in phrase_search(corpus_of(spark), table).collect()}

    def variants(slot):
        if "--" in slot:
            a, b = slot.split("--")
            return [[a + b], [a, b], [a + "-" + b], [a, "-", b]]
        return [[slot]]

    def ok(t, w):
        return re.fullmatch(t.replace("*", ".*").replace("?", "."), w) is not None

    want = set()
    for pid, phrase in phrases.items():
        for alternative in phrase.lower().split("|"):
            for choice in itertools.product(*[variants(s) for s in alternative.split()]):
                flat = [t for v in choice for t in v]
                for doc, text in DOCS:
                    toks = tokens_of(text)
                    for i in range(len(toks) - len(flat) + 1):
                        if all(ok(t, toks[i + k]) for k, t in enumerate(flat)):
                            want.add((pid, doc, i, i + len(flat)))
    shortest = {}
    for pid, doc, start, end in want:
        shortest[pid, doc, start] = min(end, shortest.get((pid, doc, start), end))
    assert got == {(*k, e) for k, e in shortest.items()}
    assert {x[0] for x in got} == {1, 2, 3, 4, 5, 6, 7}


def test_relocate(spark):
    passages = [(10, DOCS[1][1]), (11, "The cat sat on the mat."), (12, "never there at all"), (13, "The cat sat on the mat."), (14, "of"), (15, "!!")]
    table = spark.createDataFrame(passages, "item_id bigint, text string")

    def found(**kw):
        return {(x.item_id, x.doc_id, x.pos) for x in relocate(corpus_of(spark), table, **kw).collect()}

    of = {(14, 2, i) for i, w in enumerate(tokens_of(DOCS[2][1])) if w == "of"}
    assert found() == {(11, 0, 0), (13, 0, 0)} | of
    # our tokens of an address are five, more than the default gap
    assert found(url_wildcards=5) == {(10, 1, 0), (11, 0, 0), (13, 0, 0)} | of


def test_pages_cover_all_hits(spark):
    matched = m.match(with_tokens(corpus_of(spark)), [m.term("the")])
    size = c.concsize(matched).first().concsize
    pages = c.paged_hits(matched, 3).collect()
    assert len(pages) == size and {x.page for x in pages} == set(range(1, -(-size // 3) + 1))
    ordered = sorted(pages, key=lambda x: (x.doc_id, x.pos))
    assert [x.hit for x in ordered] == list(range(size))
    assert c.page(matched, 2, 3).count() == 3


def test_samples(spark):
    hits = m.hit_rows(m.match(with_tokens(corpus_of(spark)), [m.term("the")]))
    once, again = (c.sample_hits(hits, 4, seed=3).collect() for _ in range(2))
    assert sorted(once) == sorted(again) and len(once) == 4
    # a larger sample holds the smaller one
    draws = [set(c.sample_hits(hits, n, seed=3).collect()) for n in (1, 4, 7, 100)]
    assert [len(d) for d in draws[:3]] == [1, 4, 7] and all(a <= b for a, b in zip(draws, draws[1:]))
    per_doc = hits.groupBy("doc_id").count().collect()
    strata = c.stratified_sample(hits.withColumn("d", F.col("doc_id")), "d", 2, seed=3)
    assert {x.d: x["count"] for x in strata.groupBy("d").count().collect()} == {
        x.doc_id: min(2, x["count"]) for x in per_doc
    }


# --- files --------------------------------------------------------------------------


def test_call_files(spark, tmp_path):
    whole = tmp_path / "calls.json"
    whole.write_text('[\n {"call_type": "Collx", "corpname": "c", "q": "alemma,\\"bird\\""}\n]')
    lines = tmp_path / "calls.jsonl"
    lines.write_text(
        '{"call_type": "View", "corpname": "c", "q": ["a", "r5"], "pagesize": 10, "asyn": true}\n\n'
        '{"call_type": "CorpInfo", "corpname": "c"}\n'
    )
    got = {x.call_type: x.params for x in read_calls(spark, [str(whole), str(lines)]).collect()}
    assert got == {
        "Collx": {"corpname": ["c"], "q": ['alemma,"bird"']},
        "View": {"corpname": ["c"], "q": ["a", "r5"], "pagesize": ["10"], "asyn": ["True"]},
        "CorpInfo": {"corpname": ["c"]},
    }
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_calls(spark, [str(tmp_path / "none.jsonl")]).collect()


def test_response_files(spark, tmp_path):
    meta = {"url": "u", "status": 200, "reason": "OK", "headers": {"Content-Type": "text/csv"}, "ske_error": "unimplemented"}
    (tmp_path / "aa.csv").write_text("\ufeffa,b")
    (tmp_path / "aa.meta.json").write_text(json.dumps(meta, indent=2))
    (tmp_path / "bb.json").write_text("{}")
    (tmp_path / "cc.meta.json").write_text(json.dumps(meta))
    rows = src.read_responses(spark, str(tmp_path)).collect()
    assert [(x.key, x.format, x.text, x.status, x.ske_error) for x in rows] == [("aa", "csv", "a,b", 200, "unimplemented")]


def test_store(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "key string, text string, ske_error string"
    first = spark.createDataFrame([("a", "1", ""), ("b", "2", "bad"), ("c", "3", "unimplemented")], schema)
    src.append_new(spark, first, path)
    second = spark.createDataFrame([("a", "9", ""), ("b", "4", ""), ("d", "5", "bad"), ("b", "6", "")], schema)
    src.append_new(spark, second, path)
    src.append_new(spark, second, path)
    assert sorted((x.key, x.text) for x in spark.read.parquet(path).collect()) == [("a", "1"), ("b", "4"), ("c", "3")]


@pytest.mark.parametrize("fmt", ["json", "csv", "xml", "txt"])
def test_write(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "w string, n int")
    path = str(tmp_path / fmt)
    src.write_result(df, path, fmt)
    readers = {
        "json": lambda: spark.read.json(path),
        "csv": lambda: spark.read.csv(path, header=True),
        "xml": lambda: spark.read.xml(path, rowTag="row"),
        "txt": lambda: spark.read.text(path).select(F.split("value", "\t")[0].alias("w"), F.split("value", "\t")[1].alias("n")),
    }
    assert sorted((x.w, int(x.n)) for x in readers[fmt]().collect()) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        src.write_result(df, path, "yaml")


def test_format_guard(spark):
    rows = spark.createDataFrame(
        [("a", "json", "{}", {"Content-Type": "application/json"}), ("b", "csv", "x", {"Content-Type": "text/csv"})],
        "key string, format string, text string, headers map<string,string>",
    )
    assert [x.key for x in src.require_format(rows, strict=False).collect()] == ["a"]
    with pytest.raises(Exception, match="needs a json"):
        src.require_format(rows).collect()


def test_corpora(spark):
    for table in ("documents", "benchmark", "conversations"):
        corpus = with_tokens(load_corpus(spark, "/root/testdata/sf0.001", table))
        assert corpus.filter(F.size("toks") > 0).count() > 0
        assert corpus.count() == corpus.select("doc_id").distinct().count()


def test_phrases_find_lemmas(spark):
    texts = ["Two birds sing", "a bird sang", "the songs of birds"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    lemmas = spark.createDataFrame([("birds", "bird"), ("sang", "sing"), ("songs", "song"), ("bird", "bird")], "lc string, lemma string")
    phrases = [(1, "bird"), (2, "bird sing"), (3, "son*"), (4, "* bird"), (5, "birds"), (6, "?")]
    table = spark.createDataFrame(phrases, "phrase_id bigint, phrase string")
    got = {(h.phrase_id, h.doc_id, h.pos, h.end) for h in phrase_search(docs, table, lemmas=lemmas).collect()}
    want = {(1, 0, 1, 2), (1, 1, 1, 2), (1, 2, 3, 4), (2, 0, 1, 3), (2, 1, 1, 3), (3, 2, 1, 2)}
    want |= {(4, 0, 0, 2), (4, 1, 0, 2), (4, 2, 2, 4), (5, 0, 1, 2), (5, 2, 3, 4), (6, 1, 0, 1)}
    assert got == want
    plain = {(h.phrase_id, h.doc_id) for h in phrase_search(docs, table).collect()}
    assert {x for x in plain if x[0] == 1} == {(1, 1)} and (2, 0) not in plain
