"""Table, log and stream readers, and the writers that mirror them."""
