"""Column rules: fixed vocabularies, text helpers, posting rules."""
