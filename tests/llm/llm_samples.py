"""Texts that every operator must take."""

HARD = [None, "", " ", "a", "word " * 3000, "same text", "same text", "é\n\n[<\\>]"]
