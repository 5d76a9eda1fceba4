"""Operators for training data: hand cases, brute force, round trips, and odd tables."""

from __future__ import annotations

import random
from itertools import accumulate
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvida.llm import cgk_lsh, draft_errors, langid, mojibake, p1_cut_texts, p2_pairs, p3_consensus, p5_lookalikes, p6_leaks, p7_mixing, p8_garbled, truth_mixture
from corvida.llm.lookalike_transducer import LATIN_STANDINS, LOOKALIKES, canonical, compile_mapping
from corvida.llm.pair_defects import copies, fit_rendering, is_empty, is_refusal, is_truncated, left_open, tiles
from corvida.llm.prefix_cut import cut_gap

PLAIN = "Trước đây cô thợ may từng sơn mới chiếc đèn dầu, còn bây giờ thì khác."


# 1
def test_cut_value_lacks_letters_and_whole_ones_do_not():
    copies_ = [PLAIN, "Trước đây cô thở may từng sơn mới chiếc đèn dầu còn bây giờ thì khác"]
    assert cut_gap("trước đây cô thợ may từng sơn m...", copies_) > 20
    assert cut_gap("Trước đây cô thợ từng sơn mới chiếc đèn dầu, còn bây giờ thì khác", copies_) == 0
    assert cut_gap("", copies_) == 0 and cut_gap(PLAIN, []) == 0 and cut_gap("…", copies_) == 0


def test_cut_values_with_nulls_repeats_and_extra_columns(spark):
    cols = "id string, source_dataset string, asr_google string, asr_internal string, asr_phowhisper string, asr_rover string, final_asr_text string, copies string, text string"
    cut = PLAIN[:40]
    samples = spark.createDataFrame([("a::1", "d", PLAIN, None, cut, PLAIN.lower(), None, "x", "y")] * 2 + [("a::2", None, None, None, None, None, None, None, None)], cols)
    results = spark.createDataFrame([(1, "a/1", "chirp3", PLAIN), (1, "a/1", "chirp3", PLAIN), (2, "a/1", "phowhisper", cut + " …"), (3, "a/1", "phowhisper", None)], "result_id long, audio_relpath string, model_name string, text string")
    found = p1_cut_texts.cut_values(p1_cut_texts.transcripts(samples, results)).where("missing >= 4").select("table_name", "record_key").distinct()
    assert {tuple(r) for r in found.collect()} == {("samples", "a::1"), ("asr_results", "2")}
    assert p1_cut_texts.cut_values(p1_cut_texts.transcripts(samples.limit(0), results.limit(0))).count() == 0


# 2
def test_refusals_placeholders_and_copies():
    for text in ("I'm sorry, but I can't help with a translation of this passage.", "Rất tiếc, hệ thống không cho phép tôi dịch nội dung này.", "Sorry, I must refuse this translation."):
        assert is_refusal(text)
    assert not is_refusal("Sorry, I can't help, since the student hid the lamp already.")
    assert is_empty(" ​ ...") and is_empty("N/A") and is_empty("[]") and not is_empty("Không.")
    words = "the cello leads this tense piece at night".split()
    assert copies(words, words + words) and copies(words, ["bản", "dịch"] + words) and not copies(words, "đàn dẫn dắt bản nhạc".split())
    assert tiles(words, words[2:6] + ["x"]) == (4, 4) and not copies([], words)


def test_long_refusals_and_greedy_tiling():
    courtesies = " Thank you for your patience. Please send another one. I would be glad to look at it. Have a nice day. " * 4
    assert is_refusal("Hello. Good day to you. I'm sorry, but I cannot translate this text." + courtesies)
    assert tiles("a b c d e f g h".split(), "e f g h a b c x".split()) == (7, 7)
    # the longest match is marked first, though another one begins before it
    assert tiles("b c d e f g a b c".split(), "a b c d e f g".split(), 3) == (6, 6)
    assert tiles("a b c".split(), "a b c a b c a b".split()) == (3, 6) and tiles([], ["a"]) == (0, 0)


def test_pushdown_parser_finds_what_stays_open():
    assert left_open("a (b [c] d") == ["("]
    assert left_open("```python\nx = (1\n```") == []
    assert left_open("<b>x</b> <br> <i>y") == ["<i>"]
    assert left_open("“a” «b") == ["«"] and left_open(":) 1) 2)") == []


def test_rendering_tells_a_cut_translation():
    nouns = {f"tu{i}": f"noun{'x' * (i % 7)}" for i in range(30)}
    rng = random.Random(1)
    pairs = [(" ".join(c), " ".join(nouns[w] for w in c).capitalize() + ".") for c in (rng.choices(sorted(nouns), k=rng.randint(4, 9)) for _ in range(800))]
    fitted = fit_rendering(pairs)
    prompt, response = pairs[0]
    words = response.lower().rstrip(".").split()
    assert not is_truncated(prompt, prompt.split(), response, words, fitted)
    assert is_truncated(prompt, prompt.split(), " ".join(words[:2]), words[:2], fitted)
    assert fit_rendering([]).letters(["x"]) == 0


def test_renderings_are_learned_from_all_pairs(spark):
    rows = [("samples", f"r{n}", "mt_en", "en", f"tu{n} la gi", "what is this thing", None) for n in range(25_000)]
    pairs = spark.createDataFrame(rows, "table_name string, record_key string, field_name string, expected string, prompt string, response string, question_response string")
    fitted = p2_pairs.learned(pairs)["en"]
    assert {f"tu{n}" for n in range(25_000)} <= set(fitted.weights) and fitted.finals["this", "thing"] > 0.99
    assert fitted.letters(["tu24999", "la", "gi"]) == pytest.approx(15, abs=0.5)
    few = pairs.limit(60).cache()
    one, other = (p2_pairs.learned(few.repartition(n), 20)["en"] for n in (1, 3))
    assert one.finals == other.finals and one.weights == pytest.approx(other.weights)
    assert p2_pairs.learned(pairs.limit(0)) == {}


# 3
def _items(spark, rows, barred=()):
    votes = spark.createDataFrame(rows, "item string, annotator string, label int")
    return p3_consensus.votes_by_item(votes, spark.createDataFrame(list(barred), "item string, barred int"))


def _consensus(items, own, fitted, names):
    return {r["item"]: r["label"] for r in truth_mixture.consensus(items, own, fitted, names).collect()}


def test_mixture_outvotes_spammers_and_both_fits_agree(spark):
    rng = random.Random(3)
    truth = {f"i{n}": rng.randrange(3) for n in range(120)}
    swapped = {0: 1, 1: 0, 2: 2}
    rows = []
    for item, label in truth.items():
        rows += [(item, f"good{a}", label if rng.random() < 0.9 else rng.randrange(3)) for a in range(4)]
        rows += [(item, "mixes up", swapped[label] if rng.random() < 0.95 else rng.randrange(3))]
        rows += [(item, f"spam{a}", 0) for a in range(2)]
    items = _items(spark, rows).cache()
    fitted = truth_mixture.fit(items, 3)
    trust = dict(zip(fitted.names, fitted.parameters.trust))
    assert min(trust[f"good{a}"] for a in range(4)) > 0.8 > 0.2 > max(trust[f"spam{a}"] for a in range(2)) and trust["mixes up"] > 0.8
    assert dict(zip(fitted.names, fitted.parameters.reading.tolist())) == {n: [1, 0, 2] if n == "mixes up" else [0, 1, 2] for n in trust}
    found = _consensus(items, items, fitted, ("a", "b", "c"))
    assert sum(found[i] == "abc"[t] for i, t in truth.items()) > 0.95 * len(truth)
    fitted = truth_mixture.fit(items, 3, 1e-3)
    joined = truth_mixture.fit(items, 3, 1e-3, max_local=2)
    assert joined.steps == fitted.steps and joined.log_likelihood == pytest.approx(fitted.log_likelihood)
    trust = dict(zip(fitted.names, fitted.parameters.trust))
    for row in joined.table.collect():
        assert row["trust"] == pytest.approx(trust[row["annotator"]], abs=1e-6)
    found = _consensus(items, items, fitted, ("a", "b", "c"))
    assert _consensus(items, items, joined, ("a", "b", "c")) == found


def test_copied_votes_are_no_evidence(spark):
    rng = random.Random(5)
    truth, honest = {f"i{n}": rng.randrange(4) for n in range(400)}, ("n1", "n2", "n3", "n4", "n5")
    rows = []
    for item, label in truth.items():
        said = {a: label if rng.random() < 0.75 else rng.randrange(4) for a in honest}
        weak = label if rng.random() < 0.4 else rng.randrange(4)
        if rng.random() < 0.7:
            rows += [(item, "leader", weak), (item, "copier", weak), (item, "parrot", weak)]
        elif rng.random() < 0.5:
            rows += [(item, c, rng.randrange(4)) for c in ("copier", "parrot")]
        rows += [(item, a, y) for a, y in said.items()]
    items = _items(spark, rows).cache()
    rough = truth_mixture.fit(items, 4, truth_mixture.ROUGH)
    own = truth_mixture.without_copies(items, rough).cache()
    fitted = truth_mixture.fit(own, 4)
    report = {r["annotator"]: r for r in truth_mixture.annotators(items, own, fitted, tuple("abcd")).collect()}
    assert max(report[a]["copied"] for a in honest) == 0 and sum(report[a]["copied"] > 0.6 for a in ("leader", "copier", "parrot")) == 2

    def right(found):
        return sum(found[i] == "abcd"[t] for i, t in truth.items()) / len(truth)

    assert right(_consensus(items, own, fitted, tuple("abcd"))) > max(0.9, right(_consensus(items, items, rough, tuple("abcd"))))
    by_join = truth_mixture.without_copies(items, truth_mixture.fit(items, 4, 1e-2, max_local=1))
    assert abs(by_join.agg(F.sum(F.size("votes"))).first()[0] - own.agg(F.sum(F.size("votes"))).first()[0]) < 20


def test_a_draft_that_is_not_there_is_never_right(spark):
    items = _items(spark, [("x", "a", 0), ("x", "b", 0), ("x", "c", 1), ("y", "a", 0)], [("x", 1), ("z", 7)])
    fitted = truth_mixture.fit(items, 3, 1e-2)
    found = _consensus(items, items, fitted, ("a", "b", "c"))
    assert set(found) == {"x", "y"} and found["x"] == "b"
    samples = spark.createDataFrame([("x", None, "t", "t", None), ("x", None, "t", "t", None), (None, "t", "t", "t", "t")], "id string, asr_google string, asr_internal string, asr_phowhisper string, asr_rover string")
    assert [tuple(r) for r in p3_consensus.barred_labels(samples).collect()] == [("x", 9)]


def test_counting_votes(spark):
    schema = "vote_id long, sample_id string, annotator_id string, label string, voted_at timestamp, item int"
    rows = [(1, "s", "a", "Google", None, 0), (2, "s", "a", " asr_rover ", None, 0), (3, "s", "b", "???", None, 0), (4, "s", "c", None, None, 0), (5, None, "d", "none", None, 0), (6, "s", "e", "none of them", None, 0)]
    got = {(r["annotator"], r["label"]) for r in p3_consensus.counting_votes(spark.createDataFrame(rows + rows, schema)).collect()}
    assert got == {("a", 3), ("e", 4)}
    empty = p3_consensus.votes_by_item(p3_consensus.counting_votes(spark.createDataFrame([], schema)), spark.createDataFrame([], "item string, barred int"))
    fitted = truth_mixture.fit(empty, 5)
    assert truth_mixture.consensus(empty, truth_mixture.without_copies(empty, fitted), fitted, p3_consensus.LABELS).count() == 0


def test_errors_of_drafts_come_from_their_distances():
    rng = random.Random(2)
    for _ in range(200):
        a, b = (rng.choices("abcd", k=rng.randrange(9)) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = list(accumulate(zip(row, row[1:], b), lambda left, c: min(left + 1, c[1] + 1, c[0] + (c[2] != x)), initial=i))
        assert draft_errors.distance(a, b) == row[-1]
    said = "mot hai ba bon nam sau bay tam"
    assert draft_errors.errors([said.upper() + ".", said.replace("hai", "x"), None, said.replace("bon", "y").replace("nam", "z")]) == [0, 1, None, 2]
    assert draft_errors.errors([said, None, said, None]) == [None] * 4


def test_drafts_are_heard_where_annotators_disagree(spark, tmp_path):
    rng, names = random.Random(11), p3_consensus.LABELS
    vocabulary, truth, votes = [f"tu{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)], {}, []
    samples = []
    for n in range(300):
        said, label = rng.choices(vocabulary, k=14), rng.randrange(5)
        drafts = []
        for i in range(4):
            wrong = rng.sample(range(14), rng.randint(0, 1) if i == label else rng.randint(5, 7))
            drafts.append(" ".join(rng.choice(vocabulary) if k in wrong else w for k, w in enumerate(said)))
        truth[f"s{n}"] = names[label]
        samples += [(f"s{n}", *drafts, None)] * rng.randint(1, 2)
        votes += [(10 * n + k, f"s{n}", f"a{k}", names[label] if rng.random() < 0.5 else rng.choice(names), None) for k in range(4)]
    columns = ", ".join(f"{c} string" for c in p3_consensus.DRAFTS)
    spark.createDataFrame(samples, f"id string, {columns}, updated_at timestamp").write.parquet(f"{tmp_path}/samples.parquet")
    spark.createDataFrame(votes, "vote_id long, sample_id string, annotator_id string, label string, voted_at timestamp").write.parquet(f"{tmp_path}/draft_votes.parquet")
    found = p3_consensus.p3_consensus(spark, str(tmp_path)).collect()
    assert len(found) == 300 and {r["votes"] for r in found} == {4}
    assert sum(truth[r["sample_id"]] == r["label"] for r in found) > 280
    assert {r["annotator"] for r in p3_consensus.p3_annotators(spark, str(tmp_path)).collect()} == {f"a{k}" for k in range(4)}


# 4
def test_languages_of_held_out_sentences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    identifier = langid.Identifier(langid.fit_profiles(docs))
    cases = {"the night guard stored the oil lamp behind the banana garden": ["en"], "bà hàng xóm khóa chặt chiếc đèn dầu": ["vi"], "ba hang xom khoa chat chiec den dau": ["vi"],
             "今度の日曜日に、仕立屋は市場で長い話を聞かせてくれました。": ["ja"], "老渔夫在运河边想听那盘旧磁带。": ["zh"], "어제 아침에 음악 선생님은 역 뒤에서": ["ko"],
             "bà hàng xóm mượn tạm laptop ở trạm y tế": ["vi"], "": [], None: []}
    for text, langs in cases.items():
        assert [s.lang for s in identifier.stretches(text)] == langs, text
    mixed = "bà hàng xóm khóa chặt chiếc đèn dầu ở bến xe khách the night guard stored the oil lamp behind the banana garden"
    assert [s.lang for s in identifier.stretches(mixed)] == ["vi", "en"]
    assert langid.fit_profiles(docs.limit(0)) == {}
    assert [s.lang for s in langid.Identifier({}).stretches("xin chào")] == ["vi"]


def test_a_short_foreign_sentence_in_a_long_text_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    text = "Bà hàng xóm khóa chặt chiếc đèn dầu ở bến xe khách. {} Cô thợ may từng sơn mới chiếc đèn dầu, còn bây giờ thì khác."
    identifier = langid.Identifier(langid.fit_profiles(docs))
    for sentence in ("He sang there.", "Good night, Tom.", "The lamp is on."):
        assert [s.lang for s in identifier.stretches(text.format(sentence))] == ["vi", "en", "vi"], sentence


def test_readings_of_readings_are_undone():
    for page, times in (("cp1252", 6), ("mac_roman", 2), ("cp437", 2)):
        text = PLAIN
        for _ in range(times):
            try:
                text = text.encode("utf-8").decode(page)
            except UnicodeDecodeError:
                text = text.encode("utf-8").decode("latin-1")
            assert mojibake.repair(text).garbled and mojibake.repair(text).text == PLAIN, (page, text)


def test_places_of_stretches_are_those_of_the_stored_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    identifier = langid.Identifier(langid.fit_profiles(docs))
    vi, en = "bà hàng xóm khóa chặt chiếc đèn dầu ở bến xe khách.", "the night guard stored the oil lamp behind the banana garden."
    for text in (f"{vi} {en}", unicodedata.normalize("NFD", f"{vi} {en}"), f"\u200b{vi[:9]}\u200b{vi[9:]} {en}", f"{vi.upper()} {en}"):
        found = identifier.stretches(text)
        assert [s.lang for s in found] == ["vi", "en"] and text[found[1].start : found[1].end] == en[:-1]
        assert text[found[0].start : found[0].end].rstrip(".").endswith(text[text.index(en) - 3 : text.index(en) - 2])


def test_out_of_place_distance_ranks_the_n_grams_of_a_stretch():
    identifier = langid.Identifier({"vi": {"_a": 0, "a": 1, "b": 2}, "en": {"b": 0, "_a": 1}})
    # a occurs three times (rank 0), _a twice (rank 1), b once; what no profile has counts the maximum for both
    grams = [g for w in ("a", "a", "ba") for g in langid.grams(w)]
    unknown = len({g for g in grams if g not in ("_a", "a", "b")} and {len(identifier.number)})
    distances = identifier.distances(["a", "a", "ba"]).tolist()
    known = {g: grams.count(g) for g in ("_a", "a", "b")}
    rest = sum(g not in known for g in grams)
    ranks = {n: i for i, n in reversed(list(enumerate(sorted([*known.values(), rest], reverse=True))))}
    size = identifier.size
    brute = [sum(min(size, abs(p[g] - min(size, ranks[n]))) if g in p else size for g, n in known.items()) + size * unknown for p in ({"b": 0, "_a": 1}, {"_a": 0, "a": 1, "b": 2})]
    assert distances == brute


# 5
def test_one_form_is_a_fixed_point_and_keeps_real_words():
    compile_mapping()
    assert canonical("Тôі хin lỗі​") == "Tôi xin lỗi"
    assert canonical("ｃó ｍộｔ") == "có một" and canonical("ðêm") == "đêm" and canonical("tiếng") == "tiếng"
    for same in ("Từ ấy viết là хорошо.", "θάλασσα", "đọc là [ɔ̃] chứ không phải [ŋ]", "夏天，她在。", "hòa hoà", "tr�", "", None):
        assert canonical(same) == same
    rng = random.Random(5)
    letters = [*LOOKALIKES, *LATIN_STANDINS, "́", "‍", "　", "ａ", "．", "a", "b", " ", "漢", "ư"]
    for _ in range(500):
        text = "".join(rng.choices(letters, k=rng.randint(1, 12)))
        assert canonical(canonical(text)) == canonical(text)


def test_not_in_form_on_odd_tables(spark):
    rows = spark.createDataFrame([("1", "ðêm", None, "x"), ("1", "ðêm", None, "x"), ("2", "", "đêm", "y")], "id string, a string, b string, value string")
    assert [tuple(r) for r in p5_lookalikes.not_in_form(rows, "id", ("a", "b")).select("id", "field_name").distinct().collect()] == [("1", "a")]
    assert p5_lookalikes.not_in_form(rows.limit(0), "id", ("a", "b")).count() == 0


def test_clusters_of_every_order_widths_ligatures_and_other_scripts():
    mapping, letters = compile_mapping()
    assert any(len(k) == 3 for k in mapping) and all(canonical(canonical(k)) == canonical(k) for k in (*mapping, *letters))
    for text, form in {
        "e\u0323\u0302 e\u0302\u0323 \u1eb9\u0302 \u00ea\u0323": "ệ ệ ệ ệ", "ﬁn Ⅳ": "fin IV", "ｂｅ\u0301 ｔｏ": "bé to", "e\u200b\u0301": "é",
        "bа\u0300 nội": "bà nội", "ꓐank Ꭺnna օne": "Bank Anna one", "Олена приехала": "Олена приехала", "[ɑː] /aɪ/": "[ɑː] /aɪ/", "日本、（本）！": "日本、（本）！",
        "می\u200cخواهم": "می\u200cخواهم",
    }.items():
        assert canonical(text) == form and canonical(form) == form, text


# 6
def test_leaks_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdeghiklmnoprstuvxy", k=rng.randint(3, 8))) for _ in range(4000)]
    passages = [" ".join(rng.choices(vocabulary, k=40)) for _ in range(30)]
    texts, leaked = [], set()
    for n in range(300):
        words = rng.choices(vocabulary, k=120)
        if n % 3 == 0:
            p = rng.randrange(30)
            start, length = rng.randrange(20), rng.randint(14, 20)
            piece = passages[p].split()[start : start + length]
            piece[length // 2] = piece[length // 2][::-1].upper()
            words[50:50] = piece
            leaked.add((n, p))
        elif n % 3 == 1:
            words[50:50] = passages[rng.randrange(30)].split()[5:13]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)) + [(1000, None), (1001, "")], "doc_id long, text string")
    found = p6_leaks.leaks(docs, spark.createDataFrame([(p,) for p in passages] + [(None,), ("short one",)], "passage string"))
    got = {(r["doc_id"], passages.index(r["passage"])) for r in found.collect()}
    assert len(got & leaked) >= 0.9 * len(leaked) and not got - leaked
    assert p6_leaks.leaks(docs, spark.createDataFrame([], "passage string")).count() == 0
    assert cgk_lsh.PassageIndex([]).leaks(["x"]) == []


def _passages(rng, n, words, longest):
    vocabulary = ["".join(rng.choices("abcdeghiklmnoprstuvxy", k=rng.randint(3, longest))) for _ in range(4000)]
    return vocabulary, [" ".join(rng.choices(vocabulary, k=words)) for _ in range(n)]


@pytest.mark.parametrize(("kind", "least"), [("inserted letters", 95), ("stray words", 60)])
def test_shifts_inside_a_leak_do_not_hide_it(kind, least):
    rng = random.Random(61)
    vocabulary, passages = _passages(rng, 100, 40, 5)
    index, texts = cgk_lsh.PassageIndex(passages), []
    for passage in passages:
        piece = passage.split()[10:24]
        for n in (4, 9):
            piece[n] = piece[n] + " stray" if kind == "stray words" else piece[n][:2] + "z" + piece[n][2:]
        texts.append(" ".join(rng.choices(vocabulary, k=20) + piece + rng.choices(vocabulary, k=20)))
    found = {(t, p) for t, p, _, _ in index.leaks(texts)}
    assert len(found) >= least and not found - {(n, n) for n in range(100)}


def test_the_test_of_collisions_keeps_what_the_alignment_accepts():
    rng = random.Random(62)
    vocabulary, passages = _passages(rng, 40, 40, 8)
    index, texts = cgk_lsh.PassageIndex(passages), []
    for passage in passages:
        words = rng.choices(vocabulary, k=20) + passage.split()[5:30]
        for _ in range(rng.randint(1, 5)):
            n = rng.randrange(20, len(words))
            words[n : n + 1] = rng.choice([[words[n], "stray"], [], ["other"], [words[n][1:]], [words[n][:-1] + "z"], [words[n][:1] + "z" + words[n][1:]]])
        texts.append(" ".join(words))
    letters = cgk_lsh.letters_of(texts)
    shapes = cgk_lsh.Shapes.of(letters, cgk_lsh.ROOM, 1)
    begins = np.searchsorted(letters.owner, np.arange(41))
    accepted, kept_of = 0, 0
    for n in range(40):
        pairs = np.array([(begins[n] + 20 + i, 40 * n + 5 + i) for i in range(25) if begins[n] + 20 + i < begins[n + 1]])
        left, _ = index.running(shapes, letters, *pairs.T)
        for i, j in pairs.tolist():
            p, q, a, b = max(40 * n, j - 11), min(40 * n + 40, j + 12), max(begins[n], i - 13), min(begins[n + 1], i + 14)
            run = cgk_lsh.align([index.found.word(w) for w in range(p, q)], index.rare[p:q].tolist(), [letters.word(w) for w in range(a, b)], (i - a) - (j - p), 3)
            if run and run[1] >= 12:
                accepted += 1
                kept_of += i in left
    assert accepted > 150 and kept_of >= 0.97 * accepted


@pytest.mark.parametrize("kind", ["two letters", "inserted letter", "stray word", "replaced figure", "replaced name"])
def test_changes_inside_a_run_of_twelve_to_fourteen_words(kind):
    rng = random.Random(67)
    vocabulary, passages = _passages(rng, 150, 40, 8)
    passages = [" ".join(w if n % 13 else str(rng.randrange(10_000, 99_999)) for n, w in enumerate(p.split())) for p in passages]
    index, texts = cgk_lsh.PassageIndex(passages), []
    for passage in passages:
        start = rng.randrange(20)
        piece = passage.split()[start : start + rng.randint(12, 14)]
        at = 6 if kind.startswith("replaced") else rng.randrange(1, 11)
        if kind == "two letters":
            for n in rng.sample([n for n, w in enumerate(piece) if w.isalpha()], 2):
                k = rng.randrange(len(piece[n]))
                piece[n] = piece[n][:k] + rng.choice("abcdeghikl") + piece[n][k + 1 :]
        elif kind == "inserted letter":
            piece[at] = piece[at][:2] + "z" + piece[at][2:]
        elif kind == "stray word":
            piece.insert(at, "stray")
        elif kind == "replaced figure":
            piece = [*passage.split()[7:13], str(rng.randrange(10_000, 99_999)), *passage.split()[14:20]]
        else:
            piece[at : at + 2] = rng.choices(vocabulary, k=2)
        texts.append(" ".join(rng.choices(vocabulary, k=20) + piece + rng.choices(vocabulary, k=20)))
    found = {(t, p) for t, p, _, _ in index.leaks(texts)}
    assert not found - {(n, n) for n in range(150)}
    assert not found if kind.startswith("replaced") else len(found) >= 0.9 * 150


def test_a_run_counts_though_a_short_quote_stands_before_it_and_all_runs_are_told():
    rng = random.Random(68)
    vocabulary, passages = _passages(rng, 20, 100, 8)
    words = [p.split() for p in passages]
    texts = [" ".join(w[:8] + rng.choices(vocabulary, k=52) + w[60:85]) for w in words] + [" ".join(w[:15] + rng.choices(vocabulary, k=30) + w[60:80]) for w in words]
    found = sorted(cgk_lsh.PassageIndex(passages).leaks(texts))
    meant = [(n, n, 60, 25) for n in range(20)] + [(20 + n, n, first, size) for n in range(20) for first, size in ((0, 15), (60, 20))]
    assert [f[:2] for f in found] == [m[:2] for m in meant]
    # the next random word may look like the passage's
    assert all(f[2] in (m[2], m[2] - 1) and m[3] <= f[3] <= m[3] + 2 for f, m in zip(found, meant))


@pytest.mark.parametrize("kind", ["far", "shifted"])
def test_a_later_run_counts_though_an_earlier_place_of_its_bucket_does_not(kind):
    rng = random.Random(63)
    vocabulary, passages = _passages(rng, 40, 70, 8)
    index, texts = cgk_lsh.PassageIndex(passages), []
    for passage in passages:
        words = passage.split()
        broken = words[:7] + words[13:6:-1]  # all of its words are there, but no run
        if kind == "far":
            texts.append(" ".join(broken + rng.choices(vocabulary, k=31) + words[45:60]))
        else:
            texts.append(" ".join(broken + rng.choices(vocabulary, k=18) + words[22:36]))
    found = {(t, p) for t, p, _, _ in index.leaks(texts)}
    assert len(found) >= 38 and not found - {(n, n) for n in range(40)}


def test_a_short_run_hides_no_longer_one():
    words = [w.encode() for w in _passages(random.Random(64), 1, 50, 8)[1][0].split()]
    words, other = words[:30], words[30:]
    text = words[:11] + other[:3] + words[14:20] + other[3:5] + words[20:26]
    assert cgk_lsh.align(words, [False] * 30, text, 0) == (14, 12)


def test_versions_of_a_passage_do_not_hide_each_other():
    rng = random.Random(65)
    vocabulary, passages = _passages(rng, 20, 40, 8)
    versions = [" ".join([*p.split()[:32], *rng.choices(vocabulary, k=8)]) for p in passages for _ in range(5)]
    found = {(t, p) for t, p, _, _ in cgk_lsh.PassageIndex(versions).leaks([" ".join(p.split()[8:26]) for p in passages])}
    assert found == {(n // 5, n) for n in range(100)}


def test_the_verdict_does_not_depend_on_the_block(spark, monkeypatch):
    rng = random.Random(66)
    vocabulary, passages = _passages(rng, 60, 30, 5)
    passages = [" ".join([*p.split()[:10], "buong", "trong"]) for p in passages]
    docs = spark.createDataFrame([(n, p.replace("trong", "trang").replace("buong", "buang")) for n, p in enumerate(passages)], "doc_id long, text string")
    items = spark.createDataFrame([(p,) for p in passages], "passage string")
    whole = {tuple(r) for r in p6_leaks.leaks(docs, items).select("doc_id", "passage").collect()}
    assert len(whole) > 50
    monkeypatch.setattr(p6_leaks, "BLOCK_CHARACTERS", 150)
    assert {tuple(r) for r in p6_leaks.leaks(docs, items).select("doc_id", "passage").collect()} == whole


# 7
def test_mix_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(n, "ab"[n % 5 == 0], rng.randint(1, 90)) for n in range(500)] + [(900, None, 50), (901, "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, tokens long").withColumn("key", F.xxhash64(F.lit(7), "doc_id"))
    targets = spark.createDataFrame([("m", "a", 0.5, None, 1.5), ("m", "b", 0.4, 2, 1.5), ("m", "absent", 0.1, 3, 1.5)] * 2, "mix_name string, source string, target_share double, max_repeats int, size_factor double")
    got = {(r["source"], r["doc_id"]): r["copies"] for r in p7_mixing.mixed(docs, targets).collect()}
    keys = {r["doc_id"]: r["key"] for r in docs.collect()}
    total = sum(t for *_, t in rows)
    for source, share, cap in (("a", 0.5, None), ("b", 0.4, 2)):
        own = sorted((keys[d], d, t) for d, s, t in rows if s == source)
        have = sum(t for *_, t in own)
        used = min(share * 1.5 * total, cap * have if cap else share * 1.5 * total)
        epochs, rest = int(used // have), used - (used // have) * have
        before, expected = 0, {}
        for _, d, t in own:
            n = epochs + (before + t / 2 <= rest)
            before += t
            if n:
                expected[source, d] = n
        assert {k: n for k, n in got.items() if k[0] == source} == expected
    shares = {r["source"]: r["tokens"] for r in p7_mixing.shares(docs, targets).collect()}
    assert shares["absent"] == 0 and set(shares) == {"a", "b", "absent"}
    assert p7_mixing.mixed(docs.limit(0), targets).count() == 0


# 8
@pytest.mark.parametrize("page", ["cp1252", "mac_roman", "cp437", "cp850"])
def test_round_trip_of_misread_utf8(page):
    text = "Bà hàng xóm khóa chặt chiếc đèn dầu ở bến xe khách vì trời mưa to."
    table = {b: bytes([b]).decode(page, "replace") for b in range(256)}
    if page == "cp1252":
        table |= {b: chr(b) for b in range(128, 160) if table[b] == "�"}
    misread = "".join(table[b] for b in text.encode())
    fixed = mojibake.repair(misread)
    assert fixed.garbled and fixed.text == text


def test_intended_characters_are_not_garbled():
    for text in ("At 31°C nobody’s happy.", "Âm Â, Ã, Ê được đọc riêng.", "« Xin chào » — lời mở đầu", "ĐÃ KIỂM TRA", "© phòng thu 1998, £3½", "“QUÁ ĐÔNG”", "Café à la carte, naïve", "", "có không? Có."):
        assert not mojibake.repair(text).garbled, text
    assert mojibake.repair("Ch? nh?t tu?n này").lost and mojibake.repair("tr�").garbled


def test_garbled_documents_on_odd_tables(spark):
    docs = spark.createDataFrame([(1, "nhÃ  kho Ä‘Ã£", 1), (1, "nhÃ  kho Ä‘Ã£", 1), (2, None, 2), (3, "", 3), (4, "nhà kho " * 20000, 4)], "doc_id long, text string, r int")
    assert {r["doc_id"] for r in p8_garbled.garbled_documents(docs).collect()} == {1}
    assert p8_garbled.garbled_documents(docs.limit(0)).count() == 0


def test_queries_run_on_the_smallest_tables(spark):
    from corvida.llm import registry

    for name, query in registry.queries().items():
        df = query(spark, "/root/testdata/sf0.001")
        assert isinstance(df.schema, T.StructType) and df.count() >= 0, name
