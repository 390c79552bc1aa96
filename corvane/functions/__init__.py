"""Column functions: lexicons, text normalisation, similarities."""
