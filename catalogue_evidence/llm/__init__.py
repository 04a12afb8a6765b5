"""Training-data operators: thirteen corpus jobs and the queries that apply them."""
