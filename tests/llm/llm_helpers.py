"""Rows for the edge cases, and what tests of several operators share."""

SF001 = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, doc string, digest string, word string, "
          "key string, n int, cls int, score int, spans string, chunk int, ids string, version int")


def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows; and columns that clash with names used inside."""
    texts = [None, "", " ", "\n\t", "word", "token = abcdef123456789", "Der Hund läuft über die Straße. " * 3,
             "lorem ipsum dolor sit amet " * 4000, "x" * 5000, "漢字 and émigré ▁ <|endoftext|> </turn> ###", "a  b   c    d" + " " * 40 + "e", "!!!"]
    rows = [(i, t, "en" if i % 2 else None, None) for i, t in enumerate(texts)]
    rows += [rows[4], rows[5], rows[5], (None, "word", None, None), (None, None, None, None), (None, "word", None, None), (3, "another text under an id", "en", "s")]
    return [(*r, None if r[1] is None else len(r[1]), "d", "g", "w", "k", 1, 2, 3, "assign:0:1", 4, "i", 5) for r in rows]


def pairs(docs):
    """``(doc_id, text)`` of all rows."""
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def alike_words(letters):
    """Two different words of ``letters`` letters that sums modulo 2 ** 64 can't tell apart, from 1,024 on."""
    bits = [bin(i).count("1") % 2 for i in range(letters)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
