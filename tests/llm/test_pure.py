import random

import pytest

from lodestrata.llm import furniture, leakage, packing, pairs, quality, sentences, shapes, splitting
from lodestrata.llm.mixing import bisect_exponent, entropy, tempered_shares
from lodestrata.llm.words import words


def cut(text):
    return [text[a:b] for a, b in sentences.sentence_spans(text)]


@pytest.mark.parametrize(("text", "units"), [
    ("Dr. Lee met Mr. Roe at 5 p.m. in town. He left.", ["Dr. Lee met Mr. Roe at 5 p.m. in town.", "He left."]),
    ('She wrote, "Go home. Rest." and left. Then silence.', ['She wrote, "Go home. Rest." and left.', "Then silence."]),
    ("Visits end at 5 p.m. Calls go on.", ["Visits end at 5 p.m.", "Calls go on."]),
    ("It rose from 2.5 to 3.75, i.e. No. 4. pH fell.", ["It rose from 2.5 to 3.75, i.e. No. 4.", "pH fell."]),
    ("Im 2. Quartal kam z. B. nichts. Am 3. Mai ging er.", ["Im 2. Quartal kam z. B. nichts.", "Am 3. Mai ging er."]),
    ("Il dit : « Oui. Non. » puis part ! Qui vient ?", ["Il dit : « Oui. Non. » puis part !", "Qui vient ?"]),
    ("他说：“好。走吧。”然后走了。再见！", ["他说：“好。走吧。”然后走了。", "再见！"]),
    ("彼は「はい。」と言った。終わり。", ["彼は「はい。」と言った。", "終わり。"]),
    ("डॉ. राम आए। वे गए।", ["डॉ. राम आए।", "वे गए।"]),
    ("هل جاء د. علي؟ نعم.", ["هل جاء د. علي؟", "نعم."]),
    ("ไปที่โรงพยาบาล กินยา A1 สองเม็ด", ["ไปที่โรงพยาบาล", "กินยา A1 สองเม็ด"]),
    ("A heading\n\n- one. Two.\n- three\n\nLine\nbroken. End", ["A heading", "- one. Two.", "- three", "Line\nbroken.", "End"]),
    ("It left a gap of 5 mm. The clerk saw it.", ["It left a gap of 5 mm.", "The clerk saw it."]), ("This is state of the art. The office has it.", ["This is state of the art.", "The office has it."]),
    ("MM. Dupont et Roux sont venus pour la visite. Ils sont partis selon l'art. 5 du texte.", ["MM. Dupont et Roux sont venus pour la visite.", "Ils sont partis selon l'art. 5 du texte."]),
    ("Клерк дал им. Он ушёл в архив.", ["Клерк дал им.", "Он ушёл в архив."]), ("Ini kalimat꧉ Kalimat dua꧉", ["Ini kalimat꧉", "Kalimat dua꧉"]), ("ᱚᱞ ᱪᱤᱠᱤ᱾ ᱚᱞ᱾", ["ᱚᱞ ᱪᱤᱠᱤ᱾", "ᱚᱞ᱾"]),
    ("No space here.The next one.", ["No space here.", "The next one."]),
    ("", []), (" \n\n ", []),
])
def test_sentences(text, units):
    assert cut(text) == units


def test_sentence_spans_cover_all_visible_text():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(['a', 'B', '. ', '! ', '\n', '\n\n', '"', '(', ')', '- ', '1. ', '。', ' ', 'Dr. ', '…']) for _ in range(rng.randrange(60)))
        spans = sentences.sentence_spans(text)
        assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        assert "".join("".join(text[a:b].split()) for a, b in spans) == "".join(text.split())


@pytest.mark.parametrize(("prompt", "answer", "found"), [
    ("Who signs?", None, ["empty"]), ("Who signs?", " ​\n", ["empty"]), ("Who signs?", "N/A", ["empty"]), ("Who signs?", "[]", ["empty"]),
    ("Who signs it?", "A: who signs it.", ["copy"]), ("Who signs it?", "Who signs it? Who signs it?", ["copy"]),
    ("Which form must the clerk file about it and when?", "Which form must the clerk", ["copy", "truncated"]), ("Who signs?", "The clerk signs it. (§12.3)", []),
    ("Who signs?", "I'm sorry, but I can't help with that.", ["refusal"]), ("Wer prüft das?", "Dazu kann ich leider keine Auskunft geben.", ["refusal"]),
    ("What does it say?", 'It opens with "I\'m sorry, but we are unable to approve this" and then names the ground.', []),
    ("Who signs the record?", "La oficina guarda los registros durante un año según la norma.", ["language"]),
    ("Translate the input into Spanish.", "La oficina guarda los registros durante un año según la norma.", []),
    ("Who signs?", "It was returned because the transfer", ["truncated"]), ("Who signs?", "No. The clerk cannot bill this on the same day, because", ["truncated"]),
    ("Who signs?", "a deputy", []), ("How long?", "30 years", []), ("List them.", "- one\n- two", []), ("Who signs?", "(The clerk signs it.)", []),
])
def test_pairs(prompt, answer, found):
    assert pairs.defects(prompt, answer) == found


def test_payloads():
    assert pairs.pair_of('{"question": "q"}') == ("q", None) and pairs.pair_of("[1]") is None and pairs.pair_of(None) is None and pairs.pair_of("{") is None
    assert pairs.pair_of('{"output": 5, "instruction": "i"}') == ("i", "5")


@pytest.mark.parametrize(("text", "kind"), [
    (None, "junk"), (" \n", "junk"), ("null null null null null null null", "junk"), ("a\tb\tc\n1\t2\t3", "table"), ("| a | b |\n|---|---|\n| c | d |", "table"),
    ("- the form\n- the record\n- a copy of the list", "list"), ("The clerk signs the form and sends it to the office.", "prose"), ("规定适用于所有门诊，包括急诊科。", "prose"),
    ("1. the form\n2. a copy of the record", "list"),
])
def test_shapes(text, kind):
    assert shapes.shape(text) == kind


def test_statistics():
    assert quality.statistics(None) == (0, 0.0, 0.0, 0.0, 0.0)
    assert quality.statistics("the cat.\nx", "en")[:2] == (3, 7 / 3)


def test_furniture():
    lines = ["Home", "Skip to main content", "", "# Title", "", "The body of the page says something.", "More on rest", "[A](https://x.org/a)", "Rest in Wexford", "Share this page: mail | print", "The rest of it goes on here."]
    assert furniture.furniture(lines, None) == {0, 1, 6, 7, 8, 9}
    assert furniture.furniture([], None) == set()


@pytest.mark.parametrize("seed", range(4))
def test_pieces_round_trip(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["word ", "Long. ", "\n", "\n\n", "x" * 40, "句子。", ", "]) for _ in range(600))
    spans = splitting.pieces(text, 300, 40)
    assert "".join(text[a:b] for _, a, b in spans) == text
    assert all(b - f <= 300 and a - f <= 40 for f, a, b in spans)
    assert splitting.pieces("", 300, 40) == [(0, 0, 0)] and splitting.pieces("y" * 1000, 300, 40)[0] == (0, 0, 260)


def test_structure_tree():
    body = "word " * 20
    text = f"# A\n{body}\n\n## B\n\n{body}\n\n## C\n- one\n  more of one\n  - deep\n- two\n\n# D\n{body}"
    nodes = splitting.tree(text)

    def check(node):
        at = node[0]
        for child in node[2]:
            assert child[0] == at and child[0] < child[1]
            check(child)
            at = child[1]
        assert not node[2] or at == node[1]

    check(nodes)
    top = [text[a:b][:3] for a, b, _ in nodes[2]]
    assert top == ["# A", "# D"] and [text[a:b][:4].strip() for a, b, _ in nodes[2][0][2]] == ["# A", "## B", "## C"]
    for limit in (60, 110, 130, 250):
        spans = splitting._pack(text, nodes, limit)
        assert "".join(text[a:b] for a, b in spans) == text and all(b - a <= limit for a, b in spans)
        assert not any(text[a:b].rstrip().split("\n")[-1].startswith("#") for a, b in spans)
    items = "".join(f"- item {k} says\n  and goes on\n" for k in range(9))
    assert all(text.startswith("- item") for text in (items[a:b] for a, b in splitting._pack(items, splitting.tree(items), 70)))


def test_packing_plan_holds_everything():
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = np.unique(rng.integers(1, 1000, 60))
    numbers = rng.integers(1, 200, len(sizes))
    plan, lower = packing.solve(sizes, numbers, 1000, rounds=20)
    assert all((f * sizes).sum() <= 1000 for _, f in plan)
    assert (sum(n * f for n, f in plan) >= numbers).all()
    assert lower <= sum(n for n, _ in plan) <= 1.1 * (sizes * numbers).sum() / 1000 + 2
    assert packing.solve(np.array([5]), np.array([3]), 10)[0] and packing.solve(np.array([5]), np.array([0]), 10) == ([], 0.0)


def test_packing_program_beats_largest_first():
    import numpy as np

    sizes, numbers = np.array([23, 26, 27, 51]), np.array([1200, 600, 600, 600])
    plan, lower = packing.solve(sizes, numbers, 100)
    assert sum(n for n, _ in packing.largest_first(sizes, numbers, 100)) == 1100
    assert 900 <= sum(n for n, _ in plan) <= 910 and 895 <= lower <= 900


def test_tempering():
    held, wanted = {"a": 90.0, "b": 10.0}, {"a": 0.5, "b": 0.5}
    assert bisect_exponent(held, wanted, {"a": 900, "b": 900}, 100) == 1.0
    b = bisect_exponent(held, wanted, {"a": 900, "b": 20}, 100)
    assert abs(tempered_shares(held, wanted, b)["b"] - 0.2) < 1e-6
    target = 0.5
    b = bisect_exponent(held, wanted, {}, 100, target_entropy=target)
    assert abs(entropy(tempered_shares(held, wanted, b)) - target) < 1e-6


def test_index_finds_what_brute_force_finds():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, "question", [rng.choice(vocabulary) for _ in range(rng.randrange(6, 30))]) for i in range(80)]
    texts = []
    for _ in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 300))]
        src = rng.choice(items)[2]
        at = rng.randrange(len(w) + 1)
        texts.append(w[:at] + src[: rng.randrange(len(src) + 1)] + w[at:])
    index = leakage.BlockMaxIndex(items, 12)
    got = {(t, index.owner[d][0]) for t, d, _ in index.search(texts)}
    grams = lambda w: {tuple(w[i : i + 12]) for i in range(len(w) - 11)}
    want = {(t, i) for t, w in enumerate(texts) for i, _, q in items if grams(w) & grams(q)}
    assert got == want and want
    assert list(leakage.BlockMaxIndex([], 12).search(texts)) == []


def test_words():
    assert words("Ａ１b, C_d é!") == ["a1b", "c", "d", "é"] and words(None) == []
