"""DataFrame-to-DataFrame operators: mapping, filters, joins, summaries, unions, checks."""
