import random
import re

from runlens.llm.licenses import PHRASES, TEMPLATES, matching_blocks, scan_licenses, template_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(rows):
    out = {}
    for i, t in rows:
        words = WORD.findall(lower(t))
        at = [(k, p, label) for p, label in PHRASES for k in range(len(words)) if words[k: k + len(p.split())] == p.split()]
        met = {}
        for line in lower(t).split("\n"):
            have = set(WORD.findall(line))
            for label, text in TEMPLATES:
                want = template_words(text)
                share = len(have & set(want)) / len(want)
                if share >= 0.9 - 1e-9:
                    met[label] = max(met.get(label, 0), share)
        base = sorted({x for _, _, x in at})
        out[i] = (len(words), len(at), min((k for k, _, _ in at), default=None), max((k for k, _, _ in at), default=None),
                  ",".join(base), ",".join(sorted({*base, *met})), 1.0 if at else max(met.values(), default=0.0))
    return out


def test_scan_agrees_with_brute_force(spark, make_docs, hard_rows):
    rng = random.Random(2)
    rows = [r for r in hard_rows if r[0] is not None] + [
        (50, "MIT License mit license, Apache\nLicense! general public license"), (51, "x mit  license"), (52, "amit license")]
    for i in range(200):
        label, text = rng.choice(TEMPLATES)
        words = text.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(["foo", "bar"])
        rng.shuffle(words)
        rows.append((100 + i, "intro line\n" + " ".join(words) + rng.choice(["", " trailing words", "\nnext"])))
    got = {r["doc_id"]: tuple(r)[1:] for r in scan_licenses(make_docs(rows, clash=True)).collect()}
    assert got == brute(rows)


def test_blocks_name_their_line(spark, make_docs):
    got = matching_blocks(make_docs([(1, "a\nb\nReleased under the MIT License.")])).collect()
    assert [(r["doc_id"], r["line"], r["label"], r["containment"]) for r in got] == [(1, 2, "mit", 1.0)]


def test_null_id_and_empty(spark, make_docs):
    got = scan_licenses(make_docs([(None, "Licensed under CC BY-NC 4.0."), (None, None)])).collect()
    assert sorted(r["n_words"] for r in got) == [0, 7] and sorted(r["labels"] for r in got) == ["", "cc-by-nc"]     # each row by its own text
    assert scan_licenses(make_docs([])).count() == 0


def wrapped_brute(text):
    """Labels and the largest share over paragraphs and over windows of 1.5 times the template's words."""
    lines, paragraphs = [WORD.findall(x) for x in lower(text).split("\n")], [[]]
    for words in lines:
        paragraphs = paragraphs + [[]] if not words else [*paragraphs[:-1], paragraphs[-1] + words]
    run, met = sum(lines, []), {}
    for label, template in TEMPLATES:
        want, n = set(template_words(template)), -(-3 * len(WORD.findall(lower(template))) // 2)
        blocks = paragraphs + [run[k: k + n] for k in range(max(1, len(run) - n + 1))]
        share = max(len(want & set(b)) / len(want) for b in blocks)
        if share >= 0.9 - 1e-9:
            met[label] = max(met.get(label, 0), share)
    return ",".join(sorted(met)), max(met.values(), default=0.0)


def test_wrapped_notices_agree_with_brute_force(spark, make_docs):
    rng, rows, wrapped = random.Random(7), [], {}
    for k, (label, text) in enumerate(TEMPLATES):
        words = text.split()
        for j, (mark, per) in enumerate([(" * ", 9), ("# ", 5), ("rem ", 7), ("", 3)]):
            body = "\n".join(mark + " ".join(words[a: a + per]) for a in range(0, len(words), per))
            wrapped[10 * k + j] = label
            rows.append((10 * k + j, "int main;\n" * rng.randint(0, 60) + body + "\nthe end of it" * rng.randint(0, 60)))
    for i in range(200):
        words = rng.choice(TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(["foo", "bar"])
        gap = [w + rng.choice([" ", "\n", " x ", "\n\n", " \n * \n", " a b c "]) if rng.random() < 0.5 else w + " " for w in words]
        rows.append((1000 + i, "to the\n" * rng.randint(0, 40) + "".join(gap) + "\n\nand the rest" * rng.randint(0, 40)))
    got = {r["doc_id"]: (r["labels"], r["score"], r["n_base"], r["base_labels"]) for r in scan_licenses(make_docs(rows)).collect()}
    for i, text in rows:
        labels, score = wrapped_brute(text)
        base = {x for x in got[i][3].split(",") if x}
        assert got[i][0] == ",".join(sorted({x for x in labels.split(",") if x} | base)), text
        assert got[i][1] == (1.0 if got[i][2] else score), text
        assert wrapped.get(i, "") in got[i][0]


def test_rows_with_one_id_keep_their_own_labels_and_only_a_to_z_are_lowered(spark, make_docs):
    rows = [(None, "Licensed under CC BY-NC 4.0."), (None, "plain words"), (None, "This is free and unencumbered software released into the public domain."),
            (7, "Licensed under CC BY-NC 4.0."), (7, "nothing"), (8, "MIT LICENSE"), (9, "apache licenſe"), (10, "wor\u212a wor\u212a")]
    got = sorted((str(r["doc_id"]), r["labels"], r["n_words"], r["score"]) for r in scan_licenses(make_docs(rows)).collect())
    assert got == sorted([("None", "cc-by-nc", 7, 1.0), ("None", "", 2, 0.0), ("None", "unlicense", 11, 1.0), ("7", "cc-by-nc", 7, 1.0),
                          ("7", "", 1, 0.0), ("8", "mit", 2, 1.0), ("9", "", 2, 0.0), ("10", "", 2, 0.0)])
    from pyspark.sql import functions as F
    from runlens.llm.licenses import flat_words
    assert make_docs([(1, "wor\u212a")]).select(F.contains(flat_words(), F.lit("work"))).first()[0] is False
