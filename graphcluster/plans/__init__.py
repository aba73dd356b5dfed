"""Plans: the iterative driver loop helpers, the end-to-end job and the query registry."""
