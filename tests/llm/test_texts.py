"""Problems 5, 7, 8 and 9."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import canon, encode, language, mixing

PLACES = [
    (1, "Germany", "Germany", "DE", "country", ["Deutschland"]), (2, "United States", "United States", "US", "country", ["USA", "U.S.A."]), (3, "United Kingdom", "United Kingdom", "UK", "country", None),
    (4, "Worldwide", None, None, "region", ["Anywhere"]), (5, "Cambridge", "United Kingdom", "UK", "city", []), (6, "Cambridge", "United States", "US", "city", []),
    (7, "Frankfurt am Main", "Germany", "DE", "city", ["Frankfurt/Main", "Frankfurt a. M."]), (8, "Frankfurt (Oder)", "Germany", "DE", "city", []), (9, "Porto", "Portugal", "PT", "city", []),
    (10, "Linz", "Austria", "AT", "city", []), (11, "Lienz", "Austria", "AT", "city", []), (12, "São Paulo", "Brazil", "BR", "city", []),
]
TITLES = [(1, "SAP FICO Consultant", ["SAP FI/CO Consultant", "SAP FICO Berater"]), (2, "SAP PP Consultant", []), (3, "SAP Project Manager", ["SAP Projektleiter"]), (4, "SAP Basis Administrator", None)]


def test_places(spark):
    ref = spark.createDataFrame(PLACES, "ref_id bigint, name string, country string, country_code string, kind string, alt_names array<string>")
    cases = {
        "Cambridge, UK": {5}, "US, cambrigde": {6}, "Cambridge": {-1}, "Frankfurt (Oder), Deutschland (Remote)": {8}, "FRANKFURT/MAIN": {7}, "Frankfurt a. M.": {7}, "Frnakfurt am Main": {7},
        "Remote - Germany": {1}, "Greater Porto Area": {9}, "Port Ellisande": {-1}, "Linz": {10}, "lienz": {11}, "Porto or Linz": {9, 10}, "So Paulo": {12}, "United\xa0States": {2}, "UnitedStates": {2},
        "anywhere (remote)": {4}, "HQ": {-1}, "???": {-1}, "88134 Linz": {10}, "x" * 20_000: {-1}, "USA.": {2},
    }
    rows = [(i, v, "clash") for i, v in enumerate(cases)] + [(900, None, ""), (901, " ​", ""), (902, "Linz", ""), (902, "Linz", "")]
    got = {}
    for r in canon.map_places(spark.createDataFrame(rows, "row_id bigint, location string, value string"), "row_id", "location", ref).collect():
        got.setdefault(r["row_id"], []).append(r["ref_id"])
    assert {v: set(got[i]) for i, v in enumerate(cases)} == cases
    assert 900 not in got and 901 not in got and got[902] == [10, 10]


def test_titles(spark):
    ref = spark.createDataFrame(TITLES, "ref_id bigint, name string, alt_names array<string>")
    cases = {
        "Senior FI/CO Consultant (SAP) (m/f/x)": 1, "SAP FICO Cons.": 1, "sap fico conslutant | 100%": 1, "SAP PS Consultant": -1, "SAP_PP_Consultant": 2, "Consultant SAP PP": 2, "SAP Project Mgr. #12": 3,
        "SAP Basis Adm.": 4, "Consultant": -1, "SAP": -1, "Oracle EBS Consultant": -1, "SAP projektleitr (all genders)": 3,
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "row_id bigint, title string")
    got = {r["row_id"]: r["ref_id"] for r in canon.map_titles(rows, "row_id", "title", ref).collect()}
    assert {v: got[i] for i, v in enumerate(cases)} == cases
    assert canon.map_titles(rows.limit(0), "row_id", "title", ref).count() == 0


def test_similar_strings_equal_brute_force(spark):
    rng = random.Random(1)
    left = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(1, 8))) for _ in range(150)})
    right = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(2, 8))) for _ in range(60)})
    for t in (0.2, 0.5, 0.8):
        want = {(a, b) for a in left for b in right if len(set(canon.grams(a)) & set(canon.grams(b))) >= t * len(set(canon.grams(a)) | set(canon.grams(b)))}
        frame = lambda v: spark.createDataFrame([(x,) for x in [*v, None, ""]], "s string")
        got = [(r["left"], r["right"]) for r in canon.similar_strings(frame(left), frame(right), t).collect()]
        assert set(got) == want and len(got) == len(want)


TEXTS = [None, "", " ", "Hello world", "<|endoftext|> it's", "a" * 3000, "=" * 999 + " x", "日本語テキスト " * 20, "👩‍👩‍👧 é é\n\n\t z", "SAP S/4HANA №5"]


@pytest.mark.skipif(not os.path.exists(encode.VOCABULARY), reason="no vocabulary")
def test_encode(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(encode.VOCABULARY)
    tok.encode_special_tokens = True
    rows = spark.createDataFrame([(i, t, "m") for i, t in enumerate([*TEXTS, TEXTS[3]])], "doc_id bigint, text string, made string")
    made = encode.encode(rows, "doc_id", "text")
    got = {r["doc_id"]: r["ids"] for r in made.collect()}
    assert got == {i: tok.encode(t or "", add_special_tokens=False).ids for i, t in enumerate([*TEXTS, TEXTS[3]])}
    back = {r["doc_id"]: r["text"] for r in encode.decode(made, "doc_id").collect()}
    assert back == {i: t or "" for i, t in enumerate([*TEXTS, TEXTS[3]])}
    assert {r["doc_id"]: r["n_tokens"] for r in encode.with_token_counts(rows, "text").collect()} == {i: len(x) for i, x in got.items()}
    assert encode.encode(rows.limit(0), "doc_id", "text").count() == 0


def test_reachable():
    got = mixing.reachable(np.array([0.5, 0.3, 0.2]), np.array([10.0, 100.0, 100.0]), 100.0)
    assert got[0] == 10 and abs(got.sum() - 100) < 1e-9 and abs(got[1] / got[2] - 1.5) < 1e-9
    assert mixing.reachable(np.array([0.5, 0.5]), np.array([1.0, 2.0]), 100.0).tolist() == [1.0, 2.0]


@pytest.mark.skipif(not os.path.exists(encode.VOCABULARY), reason="no vocabulary")
def test_mix(spark):
    rng = random.Random(2)
    sizes = {"a": 300, "b": 60, "c": 3, "d": 40}
    docs = [(s, " ".join(["word"] * rng.randint(5, 60))) for s, n in sizes.items() for _ in range(n)]
    docs += [(None, "word word"), ("none", "word"), ("a", None), ("a", "")]
    rows = spark.createDataFrame([(i, s, t, 1) for i, (s, t) in enumerate(docs)], "doc_id bigint, source string, text string, cap int")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.35, 3), ("c", 0.05, 2), ("d", 0.2, 4), ("e", 0.0, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(rows, targets, per_bucket=50).cache()
    caps = {"a": 1, "b": 3, "c": 2, "d": 4}
    used = mixed.where("copies > 0").collect()
    assert all(r["copies"] <= caps[r["source"]] for r in used)
    total = sum(r["n_tokens"] for r in mixed.collect())
    tokens = sum(r["n_tokens"] * r["copies"] for r in used)
    assert abs(tokens - total) < 0.03 * total
    shares = {r["source"]: r["real_share"] for r in mixing.shares_of(mixed, targets).collect()}
    assert all(r["copies"] == 2 for r in used if r["source"] == "c")
    assert abs(shares["b"] / shares["a"] - 0.35 / 0.4) < 0.06 and abs(shares["d"] / shares["a"] - 0.5) < 0.06 and shares["e"] == 0
    soft = mixing.plan_mix(rows, targets, use_unlabelled=True)
    assert {r["source"] for r in soft.documents.where("copies > 0").collect()} <= {"a", "b", "c", "d", None}
    given = {r["domain"]: r for r in mixing.domain_shares(soft).collect()}
    assert set(given) == {"a", "b", "c", "d", "e"} and all(r["converged"] for r in given.values()) and abs(sum(r["share"] for r in given.values()) - 1) < 1e-6
    assert mixing.mix(rows.limit(0), targets).count() == 0 and mixing.mix(rows, targets.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.exists(encode.VOCABULARY), reason="no vocabulary")
def test_mix_meets_targets_of_labels_and_of_posteriors(spark):
    rng, docs = random.Random(7), []
    for source, n in {"a": 400, "b": 200, "c": 100}.items():
        for k in range(n):
            # a third of a's documents read like b's
            like = "b" if source == "a" and k % 3 == 0 else source
            docs.append((source, like, " ".join(f"{like}{rng.randint(0, 30)}" for _ in range(rng.randint(20, 60)))))
    rows = spark.createDataFrame([(i, s, t, x) for i, (s, x, t) in enumerate(docs)], "doc_id bigint, source string, text string, reads string")
    targets = spark.createDataFrame([("a", 0.3, 2), ("b", 0.5, 2), ("c", 0.2, 2)], "source string, target_share double, max_repeats int")
    made = mixing.plan_mix(rows, targets, per_bucket=100)
    shares = {r["source"]: r["real_share"] for r in mixing.shares_of(made.documents, targets).collect()}
    assert made.fit.converged and all(abs(shares[s] / t - 1) < 0.01 for s, t in (("a", 0.3), ("b", 0.5), ("c", 0.2)))
    used = made.documents.join(rows.select("doc_id", "reads"), "doc_id").where("source = 'a'").groupBy("reads").agg(F.avg("copies").alias("n")).collect()
    often = {r["reads"]: r["n"] for r in used}
    assert often["a"] > often["b"] + 0.1


@pytest.mark.skipif(not os.path.exists(encode.VOCABULARY), reason="no vocabulary")
def test_fit_rests_on_all_posteriors_of_the_documents(spark):
    rng, docs = random.Random(11), []
    for source, n in {"a": 200, "b": 400, "c": 60}.items():
        for k in range(n):
            # what reads of a and of c stands in one document, though b is the commonest source
            like = ("a", "c") if source == "a" and k % 2 else (source, source)
            docs.append((source, " ".join(f"{rng.choice(like)}{rng.randint(0, 30)}" for _ in range(rng.randint(3, 8)))))
    rows = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(docs)], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.4, 3), ("b", 0.3, 3), ("c", 0.3, 3)], "source string, target_share double, max_repeats int")
    made = mixing.plan_mix(rows, targets)
    weights = mixing.fit_domains(rows, "doc_id", "text", "source", ["a", "b", "c"])
    p = mixing.posteriors([t for _, t in docs], weights, mixing._Buckets())
    got = made.documents.orderBy("doc_id").collect()
    assert np.allclose([r["member"] for r in got], p, atol=1e-5)
    flow = np.array([r["n_tokens"] * r["rate"] for r in got])
    assert made.fit.converged and np.allclose(flow @ p, made.fit.expected, rtol=1e-4)
    shares = {r["domain"]: r["expected_tokens"] for r in mixing.domain_shares(made).collect()}
    assert np.allclose(np.array([r["n_tokens"] * r["copies"] for r in got]) @ p, [shares[k] for k in "abc"], rtol=1e-4)
    assert "member" not in mixing.mix(rows, targets).columns


def test_shifted_rates():
    sizes, rates = np.array([10.0, 20.0, 30.0]), np.array([0.2, 1.0, 1.9])
    got = mixing.shifted(rates, sizes, 2.0, 80.0)
    assert abs((got * sizes).sum() - 80) < 1e-6 and (got <= 2).all() and (np.diff(got) >= 0).all()
    assert mixing.shifted(rates, sizes, 1.0, 80.0).tolist() == [1, 1, 1] and mixing.shifted(rates, sizes, 1.0, 0.0).max() < 1e-9


SENTENCES = {
    "en": ["We are looking for a person who can support the team every day.", "You will document the process with your colleagues."],
    "de": ["Wir suchen eine Person, die unser Team jeden Tag unterstützt.", "Sie dokumentieren den Prozess mit den Kollegen."],
    "fr": ["Nous cherchons une personne qui aide notre équipe chaque jour.", "Vous allez documenter le processus avec vos collègues."],
    "es": ["Buscamos una persona que ayude a nuestro equipo cada día.", "Usted va a documentar el proceso con los compañeros."],
    "pt": ["Procuramos uma pessoa que ajude a nossa equipe todos os dias.", "Você vai documentar o processo com os colegas."],
    "nl": ["Wij zoeken iemand die ons team elke dag ondersteunt.", "Je gaat het proces met de collega's vastleggen."],
}


def labelled(spark):
    rng, rows = random.Random(4), []
    for lang, lines in SENTENCES.items():
        pool = [w for line in lines for w in line.rstrip(".").split()]
        for k in range(12):
            a, b = (" ".join(rng.sample(pool, 10)) + "." for _ in range(2))
            rows.append((len(rows), f"SAP Trainer\n<p>{a}</p><p>{b}</p>", lang if k else "xx", "SAP Trainer"))
    rows.append((900, None, "en", None))
    rows.append((901, "", None, None))
    rows.append((902, "SAP Support Analyst, Fin./Log.", "de", "SAP Support Analyst, Fin./Log."))
    rows.append((903, f"{SENTENCES['en'][0]} {SENTENCES['de'][1].upper()}\n{SENTENCES['de'][0]}\nRef.-Nr. 12-3\n- {SENTENCES['en'][1]}", "en_GB", None))
    rows.append((904, SENTENCES["fr"][0], "Deutsch", "x"))
    rows.append((905, (SENTENCES["nl"][0] + " ") * 3000, "nl-BE", "x"))
    rows.append((905, SENTENCES["nl"][0], "Dutch", "x"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, title string").withColumn("segments", F.lit(1))


def test_languages(spark):
    docs = labelled(spark)
    model = language.train(docs, "doc_id", "text", "lang", "title", bound=100)
    found = language.segments(docs, "doc_id", "text", model, "title")
    got = sorted(map(tuple, language.wrong_labels(found, docs, "doc_id", "lang").collect()))
    firsts = [(12 * k, 1, lang) for k, lang in enumerate(SENTENCES)]
    assert got == sorted([*firsts, (903, 1, "en"), (903, 2, "de"), (903, 3, "en"), (904, 1, "fr")])
    per = {r["doc_id"]: r for r in language.document_languages(found, "doc_id").collect()}
    assert per[1]["lang"] == "en" and per[13]["lang"] == "de" and per[900]["lang"] is None and per[901]["confidence"] == 0 and per[903]["n_languages"] == 2
    assert all(0 <= r["confidence"] <= 1 for r in per.values())
    assert language.segments(docs.limit(0), "doc_id", "text", model).count() == 0


def test_held_out_accuracy():
    rng = random.Random(5)
    train, test = [], []
    for k, (_, lines) in enumerate(SENTENCES.items()):
        pool = [w for s in lines for w in s.rstrip(".").split()]
        for i in range(60):
            (test if i % 3 == 0 else train).append((" ".join(rng.sample(pool, 7)), k if i % 10 else (k + 1) % 6))
    model = language.fit([t for t, _ in train], np.array([y for _, y in train]))
    best, _ = model.decode([t for t, _ in test])
    truth = np.repeat(np.arange(6), 20)
    assert (best == truth).mean() > 0.95


def test_codewords_differ_in_eight_bits():
    code = language.codewords()
    assert all((code[i] != code[j]).sum() == 8 for i in range(6) for j in range(i)) and (abs(code.sum(axis=0)) < 6).all()


def test_labels(spark):
    cases = {"en_GB": "en", "German": "de", "deu": "de", "Français": "fr", "pt-BR": "pt", "NL": "nl", "español (México)": "es", "Brazilian Portuguese": "pt", "de-CH-1996": "de", "ENGLISH": "en", "it": None, "xx": None, "": None, "n/a": None, "und": None, None: None}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, l string")
    got = {r["i"]: r["y"] for r in df.select("i", language.language_of(F.col("l")).alias("y")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())

