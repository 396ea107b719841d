import random
from collections import Counter

import pytest

from docprep.llm.language import fit, labelled_texts
from docprep.llm.pairs import backed_by, broken_pairs, clusters, is_copy, is_empty, is_truncated

CONTEXT = "Start daxripril at 41.5 mg daily in adults with gout. Avoid it (e.g. in children), because calcium may rise.\n\nReasons include:\na) low folate with itching\nb) chest pain lasting more than 3 days\n\nGive it for 28 weeks and stop."


@pytest.mark.parametrize("answer", [None, "", " \n", "​", "-", "—", "...", "**Answer:**", "Answer: -", "[]", "(blank)", "N/A", "null", "TBD", "?"])
def test_empty(answer):
    assert is_empty(answer)


@pytest.mark.parametrize("answer", ["No.", "13 mg", "Both.", "Not in pregnancy.", "剂", "Answer: yes"])
def test_short_but_not_empty(answer):
    assert not is_empty(answer)


QUESTION = "Which dose of tanvastatin should a nurse give to older adults with gout every day?"


@pytest.mark.parametrize("answer", [QUESTION, QUESTION.upper(), f"You asked: {QUESTION}", f"**{QUESTION}** **Answer:**", f"{QUESTION} {QUESTION}", QUESTION.replace("older ", "")])
def test_copy(answer):
    assert is_copy(QUESTION, answer)


@pytest.mark.parametrize("answer", [f'Regarding "{QUESTION[:-1]}", give 5 mg.', f"{QUESTION} Both.", "Give 5 mg.", "", "Start daxripril in older adults with gout every day and watch the folate at each visit."])
def test_not_a_copy(answer):
    assert not is_copy(QUESTION, answer) and not is_copy(None, answer)


@pytest.mark.parametrize(
    "answer", ["Start daxripril at 41.5 mg daily in", "Start daxripril at 41.5 mg da", "Start daxripril at 41.", "Start daxripril at 41.5 mg …", "Start daxripril at 41.5 mg dai-", "Reasons include: a) low folate with", "Start daxripril at 41.5 mg daily in adults with gout. Avoid it (e.g.", "Watch the folate. Give it f"]
)
def test_truncated(answer):
    assert is_truncated(answer, CONTEXT)


@pytest.mark.parametrize("answer", ["28 weeks", "Start daxripril at 41.5 mg daily in adults with gout.", "Reasons include: a) low folate with itching", "Give it for 28 weeks and stop.", "Something else entirely", "", "No."])
def test_not_truncated(answer):
    assert not is_truncated(answer, CONTEXT) and not is_truncated(answer, None)


TOLD = {
    "en": "What should the nurse do for patients with gout? Start it daily and stop after three weeks.",
    "zh": "症状持续超过三周者应转介专科。每三周应检查肾功能，必要时减少剂量。",
    "fr": "Un avis est souhaitable lorsque les symptômes durent plus de trois jours.",
}


@pytest.mark.parametrize(
    "text,code",
    [("What should the nurse do for patients with gout?", "en"), ("Environ 88 % des cas s'améliorent après 14 mois de tanpraterol.", "fr"), ("Bei Gicht darf glycipril höchstens 38 Tage lang gegeben werden.", "de"), ("症状持续超过37天者应转介专科。", "zh"), ("Jika gejala berlanjutan lebih daripada 14 hari, pesakit perlu dirujuk.", "ms"), ("13 mg", None), ("", None), (None, None)],
)
def test_language(text, code):
    models = fit(list(TOLD.values()), list(TOLD))
    assert models.name(text) == code
    other = models.differ(["What should the nurse do for patients with gout?"] * 2, [text, text])
    assert other.tolist() == [code not in (None, "en")] * 2


def test_an_answer_in_a_language_without_labelled_texts():
    asked = ["What should the nurse do for patients with gout?"] * 5 + [None, "13 mg", "Vad ska jag göra vid gikt?"]
    given = ["Patienten bör få behandling i minst tre veckor.", "Pacjent powinien przyjmować lek przez trzy tygodnie.", "Both.", "Not in pregnancy.", None, "Nie mogę odpowiedzieć.", "Nie mogę odpowiedzieć.", "Det går inte att svara på frågan."]
    assert fit([], []).differ(asked, given).tolist() == [True, True] + [False] * 6


def test_labelled_texts_are_a_bounded_sample(spark):
    rows = [(i, f"text number {i} of the language", lang) for i, lang in enumerate(["en", "EN-gb", " en", "fr", "french", "", None] * 6)] + [(100, "short", "en"), (101, None, "en"), (None, "a text without an id", "de"), (0, "text number 0 of the language", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    texts, names = labelled_texts(df, "doc_id", "text", "lang", most=5)
    assert len(texts) == len(set(texts)) and {n: names.count(n) for n in set(names)} == {"en": 5, "fr": 5}
    assert labelled_texts(df.limit(0), "doc_id", "text", "lang") == ([], [])


def test_broken_pairs(spark):
    topics = ["gout", "asthma", "croup", "eczema"]
    rows = [(i, f"Which dose of drug{i} helps patients with {t}?", f"Sorry - the passage is silent on {t}.", CONTEXT) for i, t in enumerate(topics)]
    rows += [(10, "How long should it be given to adults?", "28 weeks", CONTEXT), (11, "How?", None, None), (12, None, "Start daxripril at 41.5 mg", CONTEXT), (13, None, None, None)]
    rows += [(14, "What is the dose for the patient?", "Bei Gicht darf glycipril höchstens 38 Tage lang gegeben werden.", CONTEXT), (15, "Bei welcher Gicht darf es gegeben werden?", "Bei Gicht darf glycipril höchstens 38 Tage lang gegeben werden.", CONTEXT)]
    rows += [(16, "Why is it so for adults?", "Sorry for the long reply. Give it for 28 weeks and stop.", CONTEXT)] * 2 + [(i, f"What about topic{i} for the adults?", "Not in pregnancy.", CONTEXT) for i in range(20, 25)]
    rows += [(30, "x" * 100_000, "y " * 50_000, "z\n" * 50_000), (None, "a", "", "")]
    df = spark.createDataFrame([(*r, "clash", True) for r in rows], "qa_id bigint, question string, answer string, contexts string, defect string, supported boolean")
    assert {(r.qa_id, r.defect) for r in broken_pairs(df).collect()} == {(i, "refusal") for i in range(4)} | {(11, "empty"), (12, "truncated"), (13, "empty"), (14, "language")}


def test_empty_table(spark):
    assert broken_pairs(spark.createDataFrame([], "qa_id bigint, question string, answer string, contexts string")).count() == 0


def test_a_template_hangs_on_its_own_question_only(spark):
    refusals = [(i, f"Which dose of drug{i} helps with {t}?", "Cannot comment.", CONTEXT) for i, t in enumerate(["gout", "croup"])]
    others = [(10, "Which nurse cannot comment on drug3?", "28 weeks", CONTEXT)]
    for rows in (refusals, refusals + others):
        df = spark.createDataFrame(rows, "qa_id bigint, question string, answer string, contexts string")
        assert {(r.qa_id, r.defect) for r in broken_pairs(df).collect()} == {(0, "refusal"), (1, "refusal")}


def test_an_edited_refusal_joins_its_template(spark):
    said = ["I cannot answer this from the text given.", "I cannot answer this from the text given.", "I cannot anser this from the text given.", "Really I cannot answer this from the text.", "This I cannot answer from the text given.", "对不起我无法回答这个问题", "对不起我无法回复这个问题"]
    topics = ["gout", "asthma", "croup", "eczema", "measles", "mumps", "scabies"]
    rows = [(i, f"Which dose of drug{i} helps with {t}?" if i < 5 else f"第{t}号药物每日剂量", a, CONTEXT) for i, (t, a) in enumerate(zip(topics, said))]
    # one question and its answer, each written again with other words: not unrelated prompts
    rows += [(10 + i, f"Who may answer dosing queries {w} telephone on lundoterol in clinics?", f"Nurses cannot {w} telephone answer dosing queries.", CONTEXT) for i, w in enumerate(["by", "on"])]
    df = spark.createDataFrame(rows, "qa_id bigint, question string, answer string, contexts string")
    assert {(r.qa_id, r.defect) for r in broken_pairs(df).collect()} == {(i, "refusal") for i in range(7)}


def test_refusals_without_a_word_of_refusal_of_their_own(spark):
    said = ["Sorry, this one is for somebody who knows you.", "This one is for somebody who knows you."] + ["Kindly turn to the team that looks after you."] * 3 + ["Not in pregnancy."] * 3 + ["Take 5 tablets in the evening with the meal."] * 3
    topics = ["gout", "asthma", "croup", "eczema", "measles", "mumps", "scabies", "rubella", "polio", "colic", "sepsis"]
    rows = [(i, f"Which dose of drug{i} helps with {t}?", a, CONTEXT) for i, (t, a) in enumerate(zip(topics, said))]
    df = spark.createDataFrame(rows, "qa_id bigint, question string, answer string, contexts string")
    assert {(r.qa_id, r.defect) for r in broken_pairs(df).collect()} == {(i, "refusal") for i in range(5)}


def test_planted_refusals_in_any_words_and_script(spark):
    topics = ["gout", "asthma", "croup", "eczema", "measles", "mumps", "scabies", "rubella", "polio", "colic", "sepsis", "acne", "angina"]
    said = ["很抱歉，所给的段落没有谈到这一点。"] * 4 + ["I cannot answer this question.", "I cannot answer that question!", "Sorry, I really cannot answer this question."] + ["That is best left to a specialist colleague."] * 4
    said += ["Patienten bör få behandling i minst tre veckor.", "Pacjent powinien przyjmować lek przez trzy tygodnie."]
    rows = [(i, f"第{t}号药物每日剂量多少" if i < 4 else f"Which dose of drug{i} helps patients with {t}?", a, CONTEXT) for i, (t, a) in enumerate(zip(topics, said))]
    df = spark.createDataFrame(rows, "qa_id bigint, question string, answer string, contexts string")
    assert {(r.qa_id, r.defect) for r in broken_pairs(df).collect()} == {(i, "refusal") for i in range(11)} | {(11, "language"), (12, "language")}


def test_what_contexts_hold_is_no_refusal_and_numbers_do_not_hide_one(spark):
    shown = "The passage is silent on dosing for now. " + CONTEXT
    topics = ["gout", "asthma", "croup", "eczema", "measles", "mumps", "scabies"]
    said = ["The passage is silent on dosing for now."] * 4 + ["There is nothing here about rest.", "There is nothing here about fever.", "There is nothing here about type 2 diabetes."]
    rows = [(i, f"Which dose of drug{i} helps patients with {t}?", a, shown if i < 4 else CONTEXT) for i, (t, a) in enumerate(zip(topics, said))]
    df = spark.createDataFrame(rows, "qa_id bigint, question string, answer string, contexts string")
    assert {(r.qa_id, r.defect) for r in broken_pairs(df).collect()} == {(4, "refusal"), (5, "refusal"), (6, "refusal")}


def test_a_recurring_interjection_reveals_refusals_of_their_own_words(spark):
    said = ["Regrettably, that page has no word on the matter.", "Regrettably, it is for somebody else to say.", "In short: stay at home and rest until better.", "In short: Give it for 28 weeks and stop.", "In short: Avoid it (e.g. in children), because calcium may rise."]
    topics = ["gout", "asthma", "croup", "eczema", "measles"]
    rows = [(i, f"Which dose of drug{i} helps patients with {t}?", a, CONTEXT) for i, (t, a) in enumerate(zip(topics, said))]
    df = spark.createDataFrame(rows, "qa_id bigint, question string, answer string, contexts string")
    assert {(r.qa_id, r.defect) for r in broken_pairs(df).collect()} == {(0, "refusal"), (1, "refusal")}


def test_variants_of_a_template_are_one_cluster(spark):
    rng = random.Random(2)
    starts = ["the passage is silent on", "there is nothing here about", "a question for somebody else than me regarding", "对不起我无法回答这个问题关于"]
    slot = lambda: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9))) for _ in range(rng.randint(1, 2)))
    rows = [(i, f"{starts[i % 4]} {slot()}") for i in range(2000)]
    out = clusters(spark.createDataFrame(rows, "id bigint, template string")).collect()
    assert len(out) == 2000 and all(r.group_id % 4 == r.id % 4 for r in out)
    sizes = [max(c for c in Counter(r.group_id for r in out if r.id % 4 == k).values()) for k in range(4)]
    assert min(sizes) >= 495


def test_every_similar_pair_is_linked(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 6))) for _ in range(15)]
    bases = [[rng.choice(vocabulary) for _ in range(6)] for _ in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary) if rng.random() < 0.3 else w for w in rng.choice(bases))) for i in range(400)]

    def shares(t):
        weight = {}
        for k in range(len(t)):
            weight.setdefault(f" {t} "[k : k + 3], 2 ** (-k / 16))
        total = sum(weight.values())
        return {p: w / total for p, w in weight.items()}

    def similar(a, b):
        common = sum(min(a[p], b[p]) for p in a.keys() & b.keys())
        return common >= 0.45 * (2 - common)

    def grouped(ids):
        group = {i: i for i in ids}
        for a, b in links:
            if a in group and b in group and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
        return group

    sets = [shares(t) for _, t in rows]
    links = [(a, b) for a in range(400) for b in range(a + 1, 400) if similar(sets[a], sets[b])]
    assert {r.id: r.group_id for r in clusters(spark.createDataFrame(rows, "id bigint, template string")).collect()} == grouped(range(400))
    group = grouped(range(200))
    suspects = spark.createDataFrame([(*r, group[r[0]]) for r in rows[:200]], "id bigint, template string, group_id bigint")
    found = [tuple(r) for r in backed_by(suspects, spark.createDataFrame(rows[200:], "id bigint, template string")).collect()]
    assert sorted(found) == sorted({(group[a], b) for a, b in links if a < 200 <= b})
