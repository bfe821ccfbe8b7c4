"""Whole licence texts, clause by clause, and all documents of a table against a plain search."""

import random

import duckdb
import pytest

from stackroom.llm import license_scan as ls

CUT = {name: ls.words_of(text) for name, text in ls.TEMPLATES.items()}
CLAUSES = {name: ls.clauses_of(text) for name, text in ls.TEMPLATES.items()}
FOLDER = "/root/testdata/sf0.01"


def names(text):
    return [hit[0] for hit in ls.find_licenses(text, CUT, clauses=CLAUSES)]


def numbered(name):
    """The text as files have it: clauses numbered, lines wrapped, a copyright line first."""
    lines = [f"{i}. {line}" for i, line in enumerate(ls.TEXTS[name].strip().split("\n"))]
    return "Copyright (c) 2019, A. Holder. All rights reserved.\n * " + "\n * ".join(" ".join(lines).split(" of "))


@pytest.mark.parametrize("name", list(ls.TEXTS))
def test_whole_texts_with_changed_words(name):
    rng = random.Random(3)
    assert names("int main() {}\n" + numbered(name) + "\nreturn 0;") == [name]
    for _ in range(4):
        words = [w if rng.random() > 0.06 else "other" for w in numbered(name).split()]
        assert names(" ".join(words)) == [name]


def test_clauses_tell_licences_apart():
    two, three = ls.TEXTS["bsd-2-text"], ls.TEXTS["bsd-3-text"].strip().split("\n")
    assert names(two) == ["bsd-2-text"] and names("\n".join(three)) == ["bsd-3-text"]
    assert names(two + "\n\n" + "filler " * 30 + "\n".join(three)) == ["bsd-2-text", "bsd-3-text"]
    # Without the second clause it is neither; only the opening is found.
    assert names("\n".join([three[0], three[1], *three[3:]])) == ["bsd"]
    # A text that stops after the first clause is the opening, not the licence.
    assert names(ls.TEXTS["mit-text"].strip().split("\n")[0]) == ["mit"]
    assert names(ls.TEXTS["isc-text"].strip().split("\n")[0]) == ["isc"]


def plain(words, template):
    """Whether some chain of words aligned in order, 12 others apart at most, has 0.8 of the template and all it must have."""
    must, spec = ls.required(template), ls.LicenseSpec()
    more, best = len(template) + 1, {}
    need = spec.coverage * len(template) + more * len(must)
    for i, word in enumerate(words):
        for j, own in enumerate(template):
            if word != own:
                continue
            before = [
                value
                for (k, m), value in best.items()
                if i - spec.gap - 1 <= k < i and m < j and not any(ls.tells_apart(w, template, spec) for w in words[k + 1 : i])
            ]
            best[i, j] = 1 + more * (j in must) + max(before, default=0)
        best = {at: value for at, value in best.items() if at[0] >= i - spec.gap - 1}
        if any(value >= need for value in best.values()):
            return True
    return False


def test_every_document_of_a_table_against_a_plain_search():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    short = {name: ls.alike(words) for name, words in CUT.items() if len(words) <= 60}
    hits = 0
    for doc_id, text in rows:
        words = ls.alike(ls.words_of(text or ""))
        present = set(words)
        # Fewer of the template's words than the coverage in the whole text: no alignment can have more.
        able = {n: t for n, t in short.items() if sum(w in present for w in t) >= 0.8 * len(t)}
        wanted = any(plain(words, t) for t in able.values())
        found = names(text)
        assert bool(found) == wanted, (doc_id, found)
        hits += wanted
    assert hits > 5
