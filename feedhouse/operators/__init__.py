"""Row rules, quality, mapping, history, warehouse steps, delivery and run log."""
