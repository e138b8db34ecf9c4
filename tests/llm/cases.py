"""Rows that every operator must answer."""

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(40_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _id long, _text string, row string, kept string, "
          "quality string, mix string, sha string, _h long, found string, text_hash string, bucket int, component_id string")
EDGES = [(1, "one two three four five six", "en", "a"), (2, "one two  three\tfour five six", "en", "a"),
         (2, "one two  three\tfour five six", "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, " \n\t ", "de", "b"),
         (6, LONG, "en", "a"), (7, LONG + " tail", "en", None), (None, "one two three four five six", "en", "a"),
         (None, None, "en", "a"), (8, "short", "fr", "b"), (9, "short", "fr", "b"), (10, "ünï çödé 漢字 😀 words here", "fr", "a")]
