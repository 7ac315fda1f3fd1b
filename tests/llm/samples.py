"""Rows of every awkward kind."""

FOLDER = "/root/testdata/sf0.001"

ODD = "doc_id long, text string, lang string, source string, n_chars long, row long, size long, keys string"
ODD_ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta.\nA second line of this text follows here.", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \n\t ", "en", "b", 4),
    (5, "ALPHA beta gamma delta epsilon zeta eta theta.\nA second line of this text follows here.", "en", "a", 1),
    (5, "ALPHA beta gamma delta epsilon zeta eta theta.\nA second line of this text follows here.", "en", "a", 1),
    (6, "x" * 30_000, "en", None, 30_000),
    (7, "word " * 6_000, "en", "c", 30_000),
    (8, "Übergrößen ▁ 日本語 😀 <|endoftext|> & more", "de", "ü", 30),
    (None, "An id is missing but the text is there, as it should be.", "en", "a", 50),
    (None, "An id is missing but the text is there, as it should be.", "en", "a", 50),
    (9, "short", "en", "a", 5),
]
