"""Awkward documents: nulls, empty and long texts, ties, repeated rows."""

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))

ROWS = [(1, "The cat sat on the mat.", "en"), (2, None, "en"), (3, "", None), (4, LONG, "en"), (None, "no id here at all", "en"),
        (5, "le chat est sur la table et le chien dort", "fr"), (5, "le chat est sur la table et le chien dort", "fr"),
        (6, "x" * 5000, None), (7, " \n\t  \n ", "en"), (8, "été   déjà\n\n vu 12345 ''' don't", "fr"), (None, None, None)]
