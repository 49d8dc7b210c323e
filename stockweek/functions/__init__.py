"""Column and frame helpers shared by the operators."""
