"""Column functions: intron identifiers, motifs, alignments and p-values."""
