"""Sequencing data on Spark: sources, operators, plans and streams over reads, samples and runs."""
