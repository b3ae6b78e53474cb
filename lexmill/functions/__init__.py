"""Column functions: text normalisation, parsing, formatting and the rule library. All of them stay in Catalyst."""
