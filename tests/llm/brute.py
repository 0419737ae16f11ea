"""Plain, slow versions that the tests compare with."""

from __future__ import annotations

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORDS.findall(text or "")


def groups(nodes, linked):
    """Smallest reachable node of each, by repeated relabelling."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def odd_documents():
    """Nulls in any column, empty and white texts, ties, copies, one long text."""
    long = " ".join(f"w{i % 997}x" for i in range(30_000))
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t", None, "b", 3), (4, "one", "en", None, 3),
        (5, "One", "en", "a", 3), (6, "a b c d e f", "en", "a", 11), (7, "a b c d e f", "en", "b", 11),
        (8, long, "en", "a", len(long)), (9, long + " tail", "fr", "a", len(long) + 5), (10, "ÉCOLE é   x", "fr", "a", 11),
        (None, "a b c d e f", None, "a", 11), (11, " a\x01b \x0b c", "en", "a", 9),
    ]
