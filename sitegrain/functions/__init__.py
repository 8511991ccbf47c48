"""Column expressions: missing values, text, addresses on the web, names, ratings; and the one HTML parser."""
