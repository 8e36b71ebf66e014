import math
import random
from collections import Counter

import corpus_pipeline
import pytest
from conftest import SF001
from llm_helpers import SCHEMA, WHITE, documents, near_components, save
from test_exact_and_mixing import level_targets

import __spark_entry__ as E
from souk.llm.bpe import vocabulary_path
from souk.llm.mixing import SEED
from souk.llm.queries import QUERIES


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


LANGUAGES = {"en": "the of and to in house dog cat with from this that".split(), "de": "der die das und ist nicht haus hund mit von auf zu".split(),
             "fr": "le la les et est dans maison chien avec pour sur une".split()}


def corpus(rng):
    rows = []
    for i in range(220):
        lang = rng.choice(sorted(LANGUAGES))
        rows.append((i, sentence(rng, LANGUAGES[lang] + [f"{lang}{k}" for k in range(300)], rng.randint(8, 120)), lang, rng.choice(["a", "a", "a", "b", None])))
    for i in range(220, 260):  # exact copies but for white space
        _, t, lang, s = rng.choice(rows[:200])
        rows.append((i, t.replace(" ", rng.choice(["\n", "  ", " \t"])), lang, s))
    for i in range(260, 290):  # near copies
        _, t, lang, s = rng.choice([r for r in rows[:200] if len(r[1].split()) > 60])
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w), lang, s))
    rows += [(300, None, "en", "a"), (301, "", "en", "b"), (302, "12 34 !!", "de", "a"), (303, "the dog", None, "c")]
    return rows


def expected(rows):
    """The stages up to the mix, by brute force: {doc_id: copies}."""
    rows = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    first = {}
    for r in sorted(rows):
        first.setdefault(WHITE.sub(" ", r[1]), r)
    rows = list(first.values())
    comp = near_components([r[:2] for r in rows], 80)
    rows = [r for r in rows if comp[r[0]] == r[0]]
    size = {r[0]: len(r[1].split()) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size[r[0]]
    targets, copies = level_targets(sizes, (1, 2, 3), 3), {}
    import hashlib
    for s in sizes:
        u = int(hashlib.md5(f"{SEED}|{'n' if s is None else 's' + s}".encode()).hexdigest()[:8], 16) / 2 ** 32
        rate = targets[s] / sizes[s]
        mine = sorted((r[0] for r in rows if r[3] == s), key=lambda i: (math.floor(math.log2(size[i] + 1) * 8), i // 4096, i))
        copies |= {i: math.floor((k + 1) * rate + u) - math.floor(k * rate + u) for k, i in enumerate(mine)}
    return {i: n for i, n in copies.items() if n}


def test_pipeline_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary_path())
    rows = corpus(random.Random(21))
    out = corpus_pipeline.run(spark, save(documents(spark, rows), tmp_path))
    got = out.collect()
    assert Counter(r.doc_id for r in got) == expected(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.token_ids == ids and r.n_tokens == len(ids)


def test_stages_return_documents(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "mixing", "BPE"]
    clash = documents(spark, [(1, "the dog and the cat", "en", "a"), (2, "der hund", "de", None), (3, "1 2", "de", "b")]).selectExpr(
        "*", "1 AS score", "'x' AS size", "2 AS copy", "true AS kept", "array(1) AS token_ids", "map('a', 1) AS extra")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash, SF001)
        assert out.columns == clash.columns and {r.score for r in out.collect()} == {1}
    assert corpus_pipeline.STAGES[-1][1](spark, clash, SF001).count() == 3


def test_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, save(spark.createDataFrame([], SCHEMA), tmp_path)).count() == 0


def test_registered():
    names = set(E.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("op6_", "op8_", "op9_"))))
def test_native_plans_have_no_python(spark, name):
    from helpers import plan_text
    text = plan_text(QUERIES[name](spark, SF001), "formatted")
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "MapIn"))


def test_language_stage_without_labels(spark):
    rows = [(1, "the dog", None, "a"), (2, "12 !!", None, "a"), (3, None, None, "a"), (4, "1 2", "en", "a")]
    assert [r.doc_id for r in corpus_pipeline.language(spark, documents(spark, rows), SF001).collect()] == [1]


def test_language_stage_decides_by_phrases(spark):
    """Junk and an unlearned script go; unlabelled clean texts stay."""
    rng = random.Random(4)
    rows = [(i, sentence(rng, LANGUAGES[la], 150), la, "a") for i, la in enumerate(["en", "de", "fr"] * 40)]
    clean = [(1000 + i, sentence(rng, LANGUAGES[la], n), None, "a") for i, (la, n) in enumerate((la, n) for la in LANGUAGES for n in (1, 3, 30, 300))]
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)), "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 " * 60]
    bad = [(2000 + i, t, None, "a") for i, t in enumerate(junk)]
    got = {r.doc_id for r in corpus_pipeline.language(spark, documents(spark, rows + clean + bad), SF001).collect()}
    assert got == {r[0] for r in rows + clean}
