"""Small fixtures for every training-data operator: nulls, empties, repeats, ties, clashing columns, brute-force comparisons."""

from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkstream.llm import boilerplate as B
from inkstream.llm import encoding as EN
from inkstream.llm import leaks as LK
from inkstream.llm import mixing as MX
from inkstream.llm import quality as Q
from inkstream.llm import repeated_lines as RL
from inkstream.llm import residue as RS
from inkstream.llm import truncation as TR
from inkstream.llm.fusion import borda

ITEMS = "id string, source string, title string, body string, line_no int, kind string"


def items(spark, data):
    """Items with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*x, 5, "clash") for x in data], ITEMS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_garble_and_back():
    for chain in EN.CHAINS:
        form = EN.garble("é’ü", chain)
        if form is not None and "�" not in form and EN.ungarble(form, chain) is not None:
            assert EN.ungarble(form, chain) == "é’ü"
    assert EN.garble("isn’t", (("utf-8", "web1252"),)) == "isnâ€™t"


def test_encoding(spark):
    clean = [(f"c{i}", "s", "Grünwalde café", "Der Café in Grünwalde isn’t new — it is old. Über São Veiro.") for i in range(8)]
    bad = [("g1", "s", "GrÃ¼nwalde caf�", "fine"), ("g2", "s", None, "The cafÃ© isnâ€™t new"), ("g2", "s", None, "The cafÃ© isnâ€™t new"), ("n", None, None, None), ("e", "s", "", "")]
    df = items(spark, clean + bad)
    assert rows(EN.garbled_values(df)) == [("g1", "title"), ("g2", "body")]
    back = {(r["id"], r["field"]): r["restored"] for r in EN.restored_values(df).collect()}
    assert back["g2", "body"] == "The café isn’t new" and back["g1", "title"] == "Grünwalde café"
    assert EN.garbled_values(df.limit(0)).count() == 0


def test_encoding_forms_stay_off_the_driver(spark):
    """A word's forms are many times the words: whatever the planner takes them for, they are joined by a shuffle."""
    pairs = [(w, EN.garble(w, (("utf-8", "web1252"),))) for w in (f"Grün{chr(97 + i)}walde" for i in range(20))]
    df = items(spark, [(f"c{i}", "s", w, f"{w} {w}") for i, (w, _) in enumerate(pairs)] + [(f"g{i}", "s", None, g) for i, (_, g) in enumerate(pairs)])
    stats = EN.cut(EN.token_counts(df))
    made = EN.garbled_forms(stats)
    got = {(r["token"], r["original"]) for r in made.collect() if r["kind"] == "w"}
    assert got >= {(g, w) for w, g in pairs}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    # few rows, but long ones: the bytes count, and joins by broadcast and by shuffle give the same
    forms = EN.cut(made)
    light, heavy = EN._broadcast_if_light(forms), EN._broadcast_if_light(forms, 1000)
    assert ["strategy=broadcast" in x._jdf.queryExecution().analyzed().toString() for x in (light, heavy)] == [True, False]
    occ = EN.tokens(df, EN._wanted(forms))
    assert rows(occ.join(light, ["kind", "token"])) == rows(occ.join(heavy, ["kind", "token"])) != []
    assert EN._wanted(forms).value.tolist() == sorted(EN._hashes([r["kind"] + r["token"] for r in forms.collect()]).tolist())


def test_borda_against_loop(spark):
    nan = float("nan")
    data = [("w", 1, 1.0, 5.0), ("w", 2, 2.0, None), ("w", 3, 2.0, nan), ("w", 4, None, 1e9), ("w", 4, None, 1e9), (None, 1, 3.0, -1.0), ("v", 9, None, None)]
    df = spark.createDataFrame([(*x, "p") for x in data], "week string, topic int, a double, b double, points string")
    got = {(r["week"], r["topic"]): (r["points"], r["place"]) for r in borda(df, "week", "topic", ("a", "b"), missing={"b": -1.0}, lower=()).collect()}
    # a: 2 and 3 tie at rank 1.5 of 3, 1 is last; b: two values
    assert got["w", 1] == (0.0 + 0.0, 4) and got["w", 2] == (0.75 + 0.5, 2) and got["w", 3] == (0.75 + 0.5, 3) and got["w", 4] == (0.5 + 1.0, 1)
    assert got[None, 1] == (1.0, 1) and got["v", 9] == (1.0, 1)
    assert borda(df.limit(0), "week", "topic", ("a", "b"), missing={}, lower=()).count() == 0


def test_repeated_lines_against_brute_force(spark):
    rng = np.random.default_rng(0)
    pool = ["Share on: X · Y", "SHARE ON x y 12", "© 2024 S. All rights", "Menu", "", "12 34", "only here"]
    data = [(f"i{k}", "ab"[k % 2] * 2, None, "\r\n".join([pool[j] for j in rng.integers(0, 6, 3)] + [f"unique {'x' * k}"]) if k % 9 else None) for k in range(60)]
    data += data[:5] + [(None, "aa", None, "Menu"), ("z", None, None, "Menu")]
    df = items(spark, data)
    key = lambda x: "".join(c for c in x.lower() if c.isalpha())
    n, of = Counter(), {}
    for i, s in {(x[0], x[1]) for x in data if x[0] and x[1]}:
        n[s] += 1
    for i, s, _, b in data:
        for x in (b or "").split("\n") if i and s else ():
            if key(x):
                of.setdefault((s, key(x)), set()).add(i)
    hot = {k for k, v in of.items() if len(v) >= 3 and len(v) >= 0.05 * n[k[0]]}
    want = sorted({(i, no) for i, s, _, b in data if i and s for no, x in enumerate((b or "").split("\n"), 1) if (s, key(x)) in hot})
    places, confirmed = RL.repeated_lines(df)
    assert sorted({(r["id"], r["line_no"]) for r in places.collect()}) == want
    clean = {r["id"]: r["body_clean"] for r in RL.without_repeated_lines(df, confirmed).collect() if r["source"]}
    for i, s, _, b in data:
        if i and s:
            assert clean[i] == (None if b is None else "\n".join(x for x in b.split("\n") if (s, key(x)) not in hot))
    assert RL.repeated_lines(df.limit(0))[0].count() == 0


def test_misra_gries_bound():
    keys, counts, off = RL._reduce(np.arange(6), np.array([9, 5, 4, 3, 1, 1]), 3)
    assert off == 3 and dict(zip(keys.tolist(), counts.tolist(), strict=True)) == {0: 6, 1: 2, 2: 1}


def test_residue(spark):
    article = "The plan would let the group expand its audio library while keeping its price list in the city unchanged, people close to the talks said on Monday. " * 3
    data = [("a", "s1", None, article), ("b", "s1", None, article + "Hello {{first_name}} there."), ("c", "s2", None, "404 Not Found\nnginx"), ("d", "s2", None, None), ("e", "s2", None, "  "), ("c", "s2", None, "404 Not Found\nnginx")]
    data += [(f"t{k}", f"s{k}", None, f"Our gizmo is resting now, code {k}") for k in range(3)] + [("u", "s9", None, article + " Please enable JavaScript to view the comments.")]
    got = {i: k for i, k, _ in rows(RS.residue(items(spark, data)))}
    assert got == {"b": "slot", "c": "notice", "t0": "notice", "t1": "notice", "t2": "notice"}
    assert RS.residue(items(spark, data).limit(0)).count() == 0


def test_simhash_links_near_texts(spark):
    words = [f"w{i}" for i in range(400)]
    base = " ".join(words)
    near = " ".join(words[:200] + ["changed"] + words[201:])
    far = " ".join(f"v{i}" for i in range(400))
    df = spark.createDataFrame([(1, base), (2, near), (3, far), (4, ""), (5, "x")], "h bigint, norm string")
    bits = RS.simhashes(pa.array([base, near, far]))
    apart = bin(int(bits[0]) ^ int(bits[1])).count("1")
    assert apart < bin(int(bits[0]) ^ int(bits[2])).count("1")
    assert rows(RS.near_links(df)) == ([(1, 2)] if apart <= RS.HAMMING else [])
    assert {r[0] for r in RS.reached(RS.hashed(df), df.filter("h = 1").select("h")).collect()} == {1, 2}


def test_truncation(spark):
    end = "in time for the holiday rush."
    full = [(f"f{k}", "s", f"Report number {k} on the market", f"The firm said that it will expand the audio library by the end of the quarter. Analysts in the city welcomed the change {end}\nIt plans to rebuild the regional price list {end}") for k in range(300)]
    cut_ = [("x1", "s", None, "The firm said that it will expand the audio library by the end of the quarter. Analysts in the city welcomed the change in time for the"), ("x2", "s", None, "The firm said that it will expand the audio library by the end of the quarter. Analysts in the city welc [...]"), ("n", "s", None, None), ("e", None, "", " ")]
    df = items(spark, full + cut_ + cut_[:1])
    got = {(r["id"], r["field"]) for r in TR.truncated(df).filter("is_cut").collect()}
    assert got == {("x1", "body"), ("x2", "body")}
    by = {r["source"]: r["n_cut"] for r in TR.truncation_by_source(df).collect()}
    assert by == {"s": 2}
    assert TR.truncated(df.limit(0)).count() == 0


@pytest.mark.parametrize("scores", [[4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5], [], [-1, -2], [1, 1], [3, -1, 2, -9, 5], [2.5, -1, 2.5, -3, 2.5]])
@pytest.mark.parametrize("cost", [0.5, 2.0, 100.0])
def test_regions_against_all_choices(scores, cost):
    def best(inside):
        starts = sum(x and not y for x, y in zip(inside, (False, *inside), strict=False))
        return sum(s for s, x in zip(scores, inside, strict=True) if x) - cost * starts, -starts

    choices = product((False, True), repeat=len(scores))
    got = [False] * len(scores)
    for a, b in B.regions(scores, cost):
        got[a:b] = [True] * (b - a)
    assert best(got) == max(map(best, choices))


def test_features_of_lines():
    lines = B.features(["One line here.\n\n\u00a0 | Menu | \r\nTwo, 12 three.", "", " x ", "y\n"])
    assert list(zip(lines.text.tolist(), lines.number.tolist(), strict=True)) == [(0, 1), (0, 3), (0, 4), (2, 1), (3, 1)]
    alone = [B.features([x]).feature.tolist() for x in ("One line here.", "| Menu |", "Two, 12 three.", "x", "y")]
    assert [lines.feature[lines.of == k].tolist() for k in range(5)] == alone


def test_boilerplate(spark):
    para = "The {} group said on Monday that its regional audio library will open up the price list before the autumn season, people close to the talks welcomed the change."
    pages = [(f"p{k}", "room", None, f"Home\nMenu\nSign in\nSearch\n{para.format('first' + 'x' * k)}\nWhy it matters\n{para.format('second' + 'y' * k)}\nShare this article\nPrivacy notice Terms of use") for k in range(60)]
    feed = [(f"f{k}", "feed", f"Group {k} to open up its price list", f"{para.format('third' + 'z' * k)}\nWhy it matters\n{para.format('fourth' + 'q' * k)}") for k in range(60)]
    odd = [("n", "room", None, None), ("e", "room", None, "\n\n"), ("x", "room", None, "404 Not Found\nnginx"), pages[0]]
    src = spark.createDataFrame([("room", "newsroom"), ("feed", "feed")], "source string, kind string")
    df = items(spark, pages + feed + odd)
    got = {(r["id"], r["line_no"]) for r in B.boilerplate_lines(df, src).collect()}
    assert got == {(f"p{k}", n) for k in range(60) for n in (1, 2, 3, 4, 8, 9)}
    assert B.boilerplate_lines(df.limit(0), src).count() == 0


def test_fm_index_against_scan():
    rng = np.random.default_rng(2)
    seq = np.append(np.concatenate([rng.integers(1, 6, 800), np.tile([2, 3], 60)]), 0)
    fm = LK.FMIndex(seq, 5)
    for length in (1, 2, 4):
        phrases = rng.integers(1, 6, (20, length))
        lo, hi = fm.search(phrases)
        for p, a, b in zip(phrases, lo, hi, strict=True):
            assert sorted(fm.locate(np.arange(a, b)).tolist()) == [i for i in range(len(seq) - length + 1) if (seq[i : i + length] == p).all()]


def test_leaks(spark):
    it = "when subtitled translators misread the blind codebook only the lagged ratio built from a leaked ledger of nocturnal jingles remained usable"
    shared = "read the following passage and choose the one statement below that follows from it without further assumptions"
    evals = spark.createDataFrame([(1, f"{shared} {it}"), (2, f"{shared} across eighty sealed trials noise among tablets rose despite the census yet the dampened quantile moved the other way"), (3, None), (4, "")], "eval_id int, text string")
    w = it.split()
    w[7] = "green"
    docs = [(1, "Before. " + it.upper().replace(" ", "  \n") + " after"), (2, "x " + " ".join(w) + " y"), (3, shared), (4, " ".join(it.split()[:8])), (5, None), (6, ""), (7, "Wir " + " ".join(it.split()[:10]) + " filler " * 9 + " ".join(it.split()[10:])), (1, "Before. " + it.upper().replace(" ", "  \n") + " after")]
    df = spark.createDataFrame([(*d, 3) for d in docs], "doc_id bigint, text string, eval_id int")
    found = LK.leaks(df, evals)
    assert rows(found.select("doc_id", "eval_id")) == [(1, 1), (2, 1)]
    assert rows(LK.removal_spans(found).select("doc_id", "n_items")) == [(1, 1), (2, 1)]
    assert LK.leaks(df.limit(0), evals).count() == 0 and LK.leaks(df, evals.limit(0)).count() == 0


def test_mixing(spark):
    docs = [(k, "abc"[k % 3] if k % 10 else None, "word " * (5 + k % 7)) for k in range(300)] + [(400, "a", None), (401, "a", ""), (0, None, "word ")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, source string, text string, repeats int")
    tgt = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("none", 0.2, 5)], "source string, target_share double, max_repeats int")
    picked, shares = MX.mix(df, tgt)
    s = {r["source"]: r for r in shares.collect()}
    assert abs(s["a"]["share"] - 0.625) < 0.02 and abs(s["b"]["share"] - 0.375) < 0.02 and s["none"]["tokens"] == 0 and s["c"]["share"] == 0
    assert all(r["repeats"] <= {"a": 2, "b": 1}[r["source"]] for r in picked.collect())
    assert MX.mix(df.limit(0), tgt)[0].count() == 0
    w, a, _ = MX.mixture({"a": 100, "b": 900}, {"a": (0.9, 1), "b": (0.1, 1)}, budget=200)
    assert 0 < a < 1 and w["a"] * 200 <= 100 * (1 + 1e-6)
    w, a, _ = MX.mixture({"a": 100, "b": 900}, {"a": (0.5, 99), "b": (0.5, 99)}, budget=100, want_entropy=0.5)
    assert abs(MX.entropy(np.array(list(w.values()))) - 0.5) < 1e-3


def test_quality(spark):
    prose = "The works council in the city said that the plan does not add up, and it noted that the group had tried to open up its price list before. "
    docs = [(k, prose * (2 + k % 5) + f"By Monday the {k} partners had signed up for it.", "en") for k in range(150)]
    junk = [(900, "\n".join(f"| a{k} | {k}% | x |" for k in range(40)), "en"), (901, "\n".join(f"- item {k}" for k in range(60)), None), (902, "NEW! " * 200, "en"), (903, None, None), (904, "", "xx"), (905, "a" * 60000, "en")]
    df = spark.createDataFrame([(*d, 1.0) for d in docs + junk + docs[:2]], "doc_id int, text string, lang string, distance2 double")
    got = Q.outliers(df)
    bad = {r["doc_id"] for r in got.filter("is_outlier").collect()}
    assert {900, 901, 902} <= bad and not bad & {*range(150), 903, 904}
    r = got.filter("doc_id = 900").collect()[0]
    assert abs(sum(r[f"part_{s}"] for s in Q.STATS) - r["distance2"]) < 1e-6 * r["distance2"]
    assert got.groupBy("doc_id").count().agg(F.max("count")).collect()[0][0] == 1
    assert Q.outliers(df.limit(0)).count() == 0


def test_quality_without_letters(spark):
    prose = ["The quick fox ran over the hill and it was seen by all of the people. They said that it would be back soon, and so it was.", "A man and his dog were on the road to the town. It was late, but they had not been in a hurry, so there was time for a rest."]
    data = [(i, prose[i % 2] + f" It was day {i} of the year.", "en") for i in range(150)]
    data += [(900, "#@~ %%^ &*!! ◊◊◊ ~~~ ||| ###\n$$$ ^^^ &&&", "en"), (901, "12 | 34 | 56\n78 | 90 | 11\n22 | 33 | 44", None), (902, "2019 14 7\n2020 15 8\n2021 16 9", "de")]
    data += [(910, " \n\t ", "en"), (911, None, "en"), (912, "\u00a0\u2003\n\u200b", "en")]
    got = Q.outliers(spark.createDataFrame(data, "doc_id bigint, text string, lang string"))
    assert [r[0] for r in rows(got.filter("is_outlier").select("doc_id"))] == [900, 901, 902]


def test_residue_reaches_all_similar_texts(spark):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiouy"]
    base = list(rng.choice(words, 30))
    texts = [" ".join(base)]
    for k in range(12):  # reworded from the end: similarities just over and under 0.8
        texts.append(" ".join(base[: 30 - k] + [f"x{chr(97 + k)}{chr(97 + j)}" for j in range(k)]))
    texts += [" ".join(rng.choice(words, 30)) for _ in range(20)] + [" ".join(base[:20] + [f"q{chr(97 + j)}" for j in range(10)]), "", "ba"]
    shingles = [{tuple(t.split(" ")[i : i + 5]) for i in range(max(1, len(t.split(" ")) - 4))} for t in texts]
    want, grew = {0}, True
    while grew:
        add = {b for b in range(len(texts)) for a in want if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])} - want
        want, grew = want | add, bool(add)
    assert 3 <= len(want) < len(texts) - 20
    df = spark.createDataFrame(list(enumerate(texts)), "h bigint, norm string")
    assert {r[0] for r in RS.reached(RS.hashed(df), df.filter("h = 0").select("h")).collect()} == want
    data = [(f"k{i}", f"s{i}", None, texts[0]) for i in range(3)] + [(f"t{i}", "own", None, t) for i, t in enumerate(texts) if t]
    assert {i for i, *_ in rows(RS.residue(items(spark, data)))} == {f"k{i}" for i in range(3)} | {f"t{i}" for i in want}


def test_repeated_lines_more_than_counters(spark):
    word = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    page = "\n".join(f"line {word(i)}" for i in range(RL.COUNTERS + 500))
    data = [(f"i{k}", "catalogue", None, page + f"\nown {word(k)}") for k in range(10)] + [(f"j{k}", "other", None, "same foot\nown " + word(k)) for k in range(10)]
    got = RL.repeated_lines(items(spark, data))[1]
    assert {r["source"]: r["count"] for r in got.groupBy("source").count().collect()} == {"catalogue": RL.COUNTERS + 500, "other": 1}

#: Clean texts that the restoration tests plant: per writing, words that stand often and seldom.
CLEAN = {
    "latin": "Der Café-Betreiber in Grünwalde eröffnet früher; são Veiro señaló «más» naïve Übergänge",
    "russian": "Почему рекламная биржа нужна вещателям, сообщила компания после проверки договоров",
    "japanese": "会員制度によって広告枠を増やす方針を明らかにした",
}


@pytest.mark.parametrize("writing", CLEAN)
def test_restoration_by_chain(spark, writing):
    clean = CLEAN[writing]
    data = [(f"c{k}", "s", None, f"{t} — {'x' * k}") for t in CLEAN.values() for k in range(1, 4)]
    data = [(f"{i}-{n}", *x[1:]) for n, x in enumerate(data) for i in range(2)]
    want = {}
    for c, chain in enumerate(EN.CHAINS):
        form = EN.garble(clean, chain)
        if form and form != clean and EN.ungarble(form, chain) == clean:
            want[f"g{c}"] = clean + " … Grünwalde"
            data.append((f"g{c}", "s", None, form + " … Grünwalde"))  # clean words stand beside
    assert len(want) >= 4
    back = {r["id"]: r["restored"] for r in EN.restored_values(items(spark, data)).collect()}
    right = [i for i, t in want.items() if back.get(i) == t]
    print(writing, len(want), [(EN.CHAINS[int(i[1:])], back.get(i)) for i in want if i not in right])
    assert len(right) >= 0.9 * len(want)
    assert all(back.get(i, t) == t for i, _, _, t in data if not i.startswith("g"))


def test_residue_carried_to_variants_no_list_knows(spark):
    rng = np.random.default_rng(11)
    article = "The plan would let the group expand its audio library while keeping its price list in the city unchanged, people close to the talks said on Monday."
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud".split()
    notice = "Please enable JavaScript to run this app and then reload the page so that the reader of this site can show you the whole story with its pictures tables and notes as they were meant to be seen by all of our readers"
    data = [("n0", "s0", None, "You need to enable JavaScript to run this app" + notice[len("Please enable JavaScript to run this app") :])]
    data += [(f"n{k}", f"s{k}", None, f"Kindly {w}" + notice[6:]) for k, w in enumerate(("do", "now", "first", "just"), 1)]  # no list knows these
    data += [("f0", "s0", None, "Lorem ipsum dolor sit amet " + " ".join(filler)), ("f9", "s0", None, " ".join(filler[::-1][:-1]) + " lorem ipsum")]
    for k in range(1, 7):
        words = list(rng.choice(filler, 30))
        while any(a + " " + b in ("lorem ipsum", "sit amet", "consectetur adipiscing") for a, b in zip(words, words[1:], strict=False)):
            words = list(rng.choice(filler, 30))
        data.append((f"f{k}", f"s{k}", None, article + "\n" + " ".join(words) + "."))
    data += [("m0", "s1", None, article + " Dear {{ reader.first_name_or_nickname_1 }} again"), ("m1", "s2", None, article + " Dear {% reader.first_name_or_nickname_1 %}"), ("m2", "s3", None, article + " Dear <% reader.first_name_or_nickname_1 }"), ("a", "s4", None, article), ("b", "s5", None, article + " It said [more] and {so on}.")]
    got = {r["id"]: (r["kind"], r["how"]) for r in RS.residue(items(spark, data)).collect()}
    assert set(got) == {f"n{k}" for k in range(5)} | {f"f{k}" for k in (*range(7), 9)} | {"m0", "m1"} | ({"m2"} & set(got))
    assert {i for i, (_, how) in got.items() if how == "carried"} >= {f"n{k}" for k in range(1, 5)} | {f"f{k}" for k in range(1, 7)}


def test_link_recall_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = [[f"w{rng.integers(5000)}" for _ in range(60)] for _ in range(12)]
    texts = []
    for b in base:
        texts.append(b)
        for _ in range(4):
            t = list(b)
            for _ in range(int(rng.integers(0, 3))):
                t[int(rng.integers(len(t)))] = f"x{rng.integers(5000)}"
            texts.append(t)
    shingles = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    linked = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])}
    group = {i: min([a for a, b in linked if b == i] + [i]) for i in range(len(texts))}
    df = RS.hashed(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "h bigint, norm string"))
    found = {r[0] for r in RS.reached(df, spark.createDataFrame([(i * 5,) for i in range(12)], "h bigint")).collect()}
    want = {i for i in group if group[i] % 5 == 0}
    assert want <= found
