"""Jobs over a day range: load raw, flatten, build marts, look after the tables."""
