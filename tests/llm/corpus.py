"""Small documents with the awkward cases: nulls, empty and long texts, copies, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, hash long, start int, n long, score double")


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def rows(seed=3):
    rng = random.Random(seed)
    english = ["the", "of", "and", "house", "River", "walking", "stone", "light", "seven", "green"]
    english += [a + b for a in ("ka", "lo", "mi", "nu", "pe") for b in ("tion", "ing", "er", "ly")]
    french = ["le", "la", "et", "maison", "rivière", "marcher", "pierre", "lumière", "élan", "été"]
    french += [a + b for a in ("bou", "cha", "dé", "fi", "gué") for b in ("ment", "eux", "elle", "oir")]
    texts = []
    for i in range(60):
        lang, words = (("en", english), ("fr", french))[i % 2]
        texts.append((sentence(rng, words, rng.randint(30, 120)), lang))
    shared = sentence(rng, english, 45)
    out = [(i, t, lang, "web", len(t)) for i, (t, lang) in enumerate(texts)]
    out += [(100 + i, texts[i][0] + " " + shared, "en", "web", 1) for i in range(0, 8, 2)]
    out += [(200 + i, texts[2][0], "en", "web", 1) for i in range(5)]  # exact copies
    near = texts[4][0].split()
    for i in range(5):  # one word changed each
        changed = list(near)
        changed[7 * i + 3] = "changed%d" % i
        out.append((300 + i, "\n".join(changed), "en", "web", 1))
    loop = "again and again "
    out += [(400, None, "en", "web", None), (401, "", "fr", None, 0), (402, " \t\n ", None, "x", 1),
            (403, "One", "en", "x", 1), (404, "1234 !!! 5678", "en", "x", 1),
            (405, loop * 40, "en", "x", 1), (406, sentence(rng, english, 30_000), "en", "x", 1),
            (407, "x" * 5_000, "en", "x", 1), (408, "a b c", None, "x", 1),
            (None, texts[6][0], "en", "x", 1), (5, texts[5][0], "fr", "web", 1),  # repeated row
            (409, "été \x85 naïve 　 日本語 \U0001f600 zwölf", "fr", "x", 1)]
    return out


def documents(spark, some=None):
    found = rows() if some is None else some
    return spark.createDataFrame([(*r, "clash", 1, 2, 3, 0.5) for r in found], SCHEMA).repartition(4)
