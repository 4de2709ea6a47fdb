import random
import unicodedata

import numpy as np
import pandas as pd
import pytest

from linkwright.llm import abuse, confusables, leakage, lookalikes, packing

CASES = {
    "Plain text": "Plain text", "": "", "ＡＢＣ ＬＬＣ": "ABC LLC", "Co‍mp͏any": "Company", "a b c": "a b c", "Café": "Café", "Café": "Café",
    "oﬃce": "office", "Тabac": "Tabac", "Пекарня": "Пекарня", "Δελτα": "Δελτα", "ậ": "ậ", "ậ": "ậ", "जु­सेव": "जुसेव", "किराना": "किराना", "x\U0001F600y": "x\U0001F600y",
    "Gachecсhôt": "Gachecchôt", "1２３": "123", "tab\there": "tab here",
}


@pytest.mark.parametrize("text, expected", CASES.items())
def test_fold_text(text, expected):
    assert confusables.fold_text(text) == expected


def test_frames_equal_the_python_form(spark):
    rng = random.Random(1)
    alphabet = "abc\u00e9 o\u0301\u0323\u0410\u0441\u0435\uff21\ufb03\u200b\u00a01\u034f"
    texts = list(CASES) + ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(150)] + ["Ａ" * 20000, None]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, t string, folded string")
    rows = {r["id"]: r["t_folded"] for r in lookalikes.fold_columns(frame, ["t"]).collect()}
    assert len(rows) == len(texts)
    assert {i: (t, rows[i]) for i, t in enumerate(texts) if rows[i] != confusables.fold_text(t)} == {}
    with pytest.raises(ValueError):
        lookalikes.fold_columns(frame.withColumnRenamed("folded", "t_folded"), ["t"])


def test_records_not_consistent(spark):
    rows = [("1", "Plain"), ("2", "Ｐlain"), ("2", "Ｐlain"), ("3", None), ("4", ""), ("5", "Café"), ("6", "Café"), ("7", "क़ लम"), ("8", "Дом"), ("9", "Дoм")]
    frame = spark.createDataFrame(rows, "k string, t string")
    assert {r[0] for r in lookalikes.records_not_consistent(frame, "k", "t").collect()} == {"2", "6", "9"}
    assert lookalikes.records_not_consistent(frame.limit(0), "k", "t").isEmpty()


ITEM = "Which of the 642 sextants named in the charter of Bochuno did the gilded council of Vogevi refuse to sign at noon yesterday"


def cues(words, size=3):
    return "".join(f"{i}\n00:00:{i:02d},000 --> 00:00:{i + 1:02d},000\n{' '.join(words[i * size : (i + 1) * size])}\n\n" for i in range(-(-len(words) // size)))


def found(spark, *texts, item=ITEM):
    frame = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, item_text string")
    return {r["doc_id"]: r for r in leakage.leaks(frame, items, block=2).collect()}


def test_passages(spark):
    words = ITEM.split()
    hurt = list(words)
    hurt[5], hurt[9] = "narned", "chart3r"
    other = [w if w not in ("642", "Bochuno", "gilded", "Vogevi") else x for w, x in zip(words, ["a", "b", "c", "913"] + ["Nobody"] * 30)]
    texts = [
        "Before. " + ITEM + " After.", cues(words), cues([w.upper() for w in words], 4), "\r\n".join(f"<i>{w}</i>" for w in words), cues(hurt), " ".join(words[3:15]), " ".join(words[3:14]),
        " ".join(other), None, "", "x " * 20000 + ITEM, " ".join(words[:6]) + " [door creaks] " + " ".join(words[6:14]), " ".join([words[0] + words[1], *words[2:5], words[5] + words[6], *words[7:14]]),
    ]
    got = found(spark, *texts)
    assert set(got) == {0, 1, 2, 3, 4, 5, 10, 11, 12}
    assert texts[0][got[0]["first_char"] : got[0]["end_char"]] == ITEM and got[0]["words"] == len(words)
    assert got[5]["words"] == 12


def test_common_wording_leaks_in_every_window(spark):
    """Every twelve-word window of items that share nearly all their wording, also with damaged or glued words."""
    texts = [f"{name} and the failed engineers of the mill measured a drop of {n} units and blamed the porous {thing} for it" for n, name, thing in zip((717, 318, 905, 226, 431), ("Bochuno", "Vogevi", "Hocheti", "Piyuva", "Kusago"), ("lids", "seal", "pipe", "kiln", "clay"))]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, item_text string")
    documents, expected = [], set()

    def add(item, text):
        expected.add((item, len(documents)))
        documents.append((len(documents), text))

    for item, text in enumerate(texts):
        words = text.split()
        for first in range(len(words) - 11):
            part = words[first : first + 12]
            add(item, "Nobody spoke. " + " ".join(part) + " Then it rained.")
            add(item, cues(part, 2))
            for k in range(1, 11):
                if part[k].isdigit():
                    continue
                add(item, " ".join([*part[:k], part[k][:-1] + "x" + part[k][-1], *part[k + 1 :]]))
                if k < 10:
                    add(item, " ".join([*part[:k], part[k] + part[k + 1], *part[k + 2 :]]))
            many = [w if k % 3 != 1 or w.isdigit() else w + "x" for k, w in enumerate(part[:-1])] + part[-1:]
            add(item, " ".join(many))
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    got = {(r["item_id"], r["doc_id"]) for r in leakage.leaks(frame, items).collect()}
    assert [documents[doc][1] for item, doc in sorted(expected - got)] == []


def test_items_with_one_opening_all_leak(spark):
    opening = "the committee of the northern valley met at the old hall to hear what the new surveyor had found"
    items = spark.createDataFrame([(i, f"{opening} {x} and nobody could explain why the {x} had moved") for i, x in enumerate(("reef", "kiln", "mast", "gate", "loom"))], "item_id long, item_text string")
    documents = spark.createDataFrame([(0, f"Well. {opening} Then it rained."), (1, f"{opening} kiln and nobody could explain why the kiln had moved"), (2, " ".join(opening.split()[:11]))], "doc_id long, text string")
    got = {(r["item_id"], r["doc_id"]) for r in leakage.leaks(documents, items, block=2).collect()}
    assert got == {(i, d) for i in range(5) for d in (0, 1)}


@pytest.mark.parametrize(
    "item",
    [
        "почему старый маяк у северной бухты погас когда последний смотритель ушёл в город за новой лампой и не вернулся",
        "पुराने बाजार की दुकान के मालिक ने कल शाम को बताया कि नदी के पास वाली सड़क अगले महीने से बंद रहेगी",
    ],
)
def test_other_scripts(spark, item):
    words = item.split()
    texts = [cues(words), item.upper() + "!", " ".join(words[2:14]), " ".join(words[2:13]), "Well, " + ", ".join(words), "nothing at all"]
    assert set(found(spark, *texts, item=item)) == {0, 1, 2, 4}


def test_numbers_are_never_damaged_words():
    assert not leakage.damaged("643", "642") and leakage.damaged("6l2", "612") and leakage.damaged("tlie", "the") and not leakage.damaged("copper", "hollow")


def test_wrong_encoding(spark):
    item = "Pourquoi le réservoir décrit par Hocheti cède-t-il quand le lingot poreux atteint 300 degrés près de Piyuva chaque année"
    broken = item.encode().decode("cp1252", "replace")
    assert set(found(spark, broken, unicodedata.normalize("NFD", item), item=item)) == {0, 1}


BAD = ["get lost you filthy {}", "shut your mouth you worthless {}", "what a pathetic {} you are"]
GOOD = ["bring the {} to the mill", "who found the {} at noon", "the {} is closed on tuesday", "the {} crowed at five"]
WORDS = ["bastard", "idiot", "rat"]
THINGS = ["boat", "lantern", "letter", "cock", "map", "ledger", "violin"]


def corpus(rng, flagged, lines=8):
    out = [rng.choice(GOOD).format(rng.choice(THINGS)).capitalize() + "." for _ in range(lines)]
    if flagged:
        out[rng.randrange(lines)] = rng.choice(BAD).format(rng.choice(WORDS)).capitalize() + "!"
    return cues(out, 1)


def test_held_out_documents():
    rng = random.Random(3)
    train = [(corpus(rng, i % 4 == 0), int(i % 4 == 0)) for i in range(240)]
    train[1] = (train[1][0], 1)  # a wrong label
    model = abuse.train(train)
    score = lambda t: 1 - model.probabilities(abuse.sentences(t))[:, 0].min()
    tests = [(corpus(rng, i % 2 == 0), i % 2 == 0) for i in range(60)]
    assert np.mean([(score(t) >= 0.5) == y for t, y in tests]) >= 0.95
    assert score("1\n00:00:01,000 --> 00:00:02,000\nget lost, you...\n\n2\n00:00:03,000 --> 00:00:04,000\nf.i.l.t.h.y bаstаrd!\n") >= 0.5


def precision_and_recall(documents, seed, tests):
    model = abuse.train(documents, seed)
    hits = [max(1 - model.probabilities(abuse.sentences(t))[:, 0], default=0) >= 0.5 for t, _ in tests]
    right = sum(h and y for h, (_, y) in zip(hits, tests))
    return right / max(1, sum(hits)), right / sum(y for _, y in tests)


def test_more_labels_never_cost_precision():
    # every tenth label is wrong, and half of those on flagged documents; test texts are four times as long
    rng = random.Random(5)
    documents = [(corpus(rng, i % 12 == 0), int(i % 12 == 0 or i % 12 == 1)) for i in range(1500)]
    tests = [(corpus(rng, i % 8 == 0, 32), i % 8 == 0) for i in range(400)]
    for seed in range(5):
        few, many = (precision_and_recall(documents[:n], seed, tests) for n in (150, 1500))
        assert many[0] >= max(0.95, few[0] - 0.02) and many[1] >= 0.95, (seed, few, many)


def test_training_judges_documents_together(monkeypatch):
    # a call per document cost more than what it did; and a document's sentences are judged as they were alone
    rng, calls, hashed = random.Random(3), [], abuse.hashed
    documents = [(corpus(rng, i % 4 == 0), int(i % 4 == 0)) for i in range(240)]
    monkeypatch.setattr(abuse, "hashed", lambda items: calls.append(len(items)) or hashed(items))
    model = abuse.train(documents)
    assert len(calls) < 60
    monkeypatch.setattr(abuse, "CHUNK", 40)
    bags = [abuse.sentences(t) for t, _ in documents[:50]] + [[], ["ab"]]
    together = list(model.harm(bags))
    assert [len(x) for x in together] == [len(bag) for bag in bags] and not list(model.harm([]))
    assert all((x == 1 - model.probabilities(bag)[:, 0]).all() for x, bag in zip(together, bags))


def test_tasks_get_the_letter_table(monkeypatch):
    model = abuse.Model(np.ones((abuse.BUCKETS, 4), np.float32), np.zeros(4, np.float32))
    run = abuse._score(model, "doc_id")
    monkeypatch.setattr(abuse, "_TABLE", {})
    monkeypatch.setattr(abuse, "mapping", lambda: pytest.fail("a task builds the table"))
    abuse.normal.cache_clear()
    assert next(run(iter([pd.DataFrame({"doc_id": [1], "text": ["bаstаrd café"]})]))).score[0] == 0.75
    assert abuse.normal("bаstаrd café") == "bastard cafe"


def test_best_threshold():
    scores, flagged = np.array([0.9, 0.8, 0.7, 0.3, 0.2, 0.1]), np.array([True, True, False, False, True, False])
    assert 0.7 < abuse.best_threshold(scores, flagged, 1.0) < 0.8
    assert abuse.best_threshold(np.zeros(3), np.array([True, False, False]), 1.0) == 0.5
    assert abuse.best_threshold(scores, np.zeros(6, bool), 1.0) == 0.5


def test_sample_is_bounded(spark):
    documents = spark.createDataFrame([(i, "x" * 10) for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 10), None, "r") for i in range(50)], "doc_id long, flagged int, category string, reviewer string")
    sample, weight = abuse.labelled(documents, labels, most_flagged=5, most_clean=40, most_letters=200)
    assert [sum(label > 0 for _, label in sample), len(sample)] == [5, 25] and weight == 1.0
    assert abuse.labelled(documents, labels.where("flagged = 0")) [1] == 1.0


def test_sentence_forms():
    assert abuse.sentences("{\\an8}get out[you rat] {y:i}go {really bad}{12}{34}so") == ["get out", "you rat", "go", "really bad", "so"]
    assert abuse.sentences("1\n00:00:01,000 --> 00:00:02,000\n<i>F.u.c.k you,</i>\nJessop. i d i o t!\n") == ["fuck you jessop", "idiot"]
    assert abuse.sentences("raaaats sh1t fuсk") == ["rats shit fuck"]
    assert abuse.sentences("Ã‰coute-moi") == ["ecoute moi"]
    assert abuse.sentences(None) == [] == abuse.sentences("")


def test_splits_and_characters_outside_the_encoding():
    assert abuse.sentences("- one\n \t- two\n--three\n– four -five\n-six") == ["one", "two three", "four five six"]
    assert abuse.sentences("the end.. of it.\"Go\" now... stop!! no!?\n\nyes. e.g this") == ["the end of it", "go now stop", "no", "yes", "e g this"]
    assert abuse.sentences("x1 y@z 4u s!t wait! ca$ we 're00 1a1b") == ["xi yaz 4u sit wait", "ca$ we 're00 1aib"]
    assert abuse.repaired("Ã© \x81жЖ中\x9d ÿ") == b"\xc3\xa9 \x81\xd0\xb6\xd0\x96\xe4\xb8\xad\x9d \xff".decode("utf-8", "replace")


def test_scores(spark):
    rng = random.Random(4)
    rows = [(i, corpus(rng, i % 3 == 0), "a" if i % 2 else None, 9.0) for i in range(90)] + [(900, None, "a", 1.0), (901, "", "b", 1.0)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "abuse" if i % 3 == 0 else None, "r") for i in range(90)], "doc_id long, flagged int, category string, reviewer string")
    out = abuse.scores(documents, labels)
    got = {r["doc_id"]: r["score"] for r in out.collect()}
    assert len(got) == 92 and got[900] == got[901] == 0.0
    assert np.mean([(got[i] >= 0.5) == (i % 3 == 0) for i in range(90)]) > 0.9
    assert sum(r["documents"] for r in abuse.rates(documents.drop("score"), out).collect()) == 92
    assert {r["score"] for r in abuse.scores(documents, labels.where("flagged = 0")).collect()} == {0.0}


def test_packing(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 5, 60, 300, 700, 2600])) for i in range(400)] + [(500, 0), (501, None), (7, 60)]
    counts = spark.createDataFrame(rows, "doc_id long, tokens long")
    capacity = {1: 512, 2: 2048}
    packed = packing.pack(counts, capacity, group_tokens=60_000).toPandas()
    for limit, most in capacity.items():
        own = packed[packed.limit_id == limit]
        assert own.groupby("container").tokens.sum().max() <= most
        sizes = sorted(own.groupby("doc_id").tokens.sum().tolist())
        totals = {}
        for i, n in rows:
            totals[i] = totals.get(i, 0) + (n or 0)
        assert sizes == sorted(v for v in totals.values() if v)
        assert own[own.tokens < most].groupby(["doc_id", "first_token"]).size().max() <= 2
        assert own.tokens.sum() / (own.container.nunique() * most) > 0.85
    with pytest.raises(ValueError):
        packing.pack(counts, {1: 0})
    assert packing.pack(counts.limit(0), capacity).isEmpty()


def test_token_counts(spark):
    encode = packing.encoder(f"{packing.TOKENIZERS}/{packing.VOCABULARY}").encode_ordinary
    texts = ["Hello there, friend.", "", None, "नमस्ते", "x" * 50000]
    rows = packing.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert {r["doc_id"]: r["tokens"] for r in rows} == {i: len(encode(t or "")) for i, t in enumerate(texts)}
