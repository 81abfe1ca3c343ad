"""Column expressions: text, HTML, vectors and term counting."""
