"""Odd documents that every operator must take."""

SF_DIR = "/root/testdata/sf0.01"

LONG = " ".join(f"word{i % 977} and, then{i % 31}." for i in range(12_000))
# Columns whose names the operators use inside.
EXTRA = ["row", "block", "key", "node", "score", "label", "hash", "name", "n_shingles", "__row", "__hash", "__shard"]
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "One two three four five six seven."),
    (5, "one two THREE four five six seven."),
    (5, "one two THREE four five six seven."),
    (None, "one two three four five six seven."),
    (6, LONG),
    (7, LONG.upper()),
    (8, LONG + " more"),
    (9, "short"),
    (10, "Ünïcode ßtraße 中文 \U0001f600 <|endoftext|> it's"),
]
