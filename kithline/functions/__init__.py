"""Column functions: text normalisation, tokens, similarities."""
