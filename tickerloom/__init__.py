"""tickerloom: trade-stream analytics as plain DataFrame -> DataFrame functions."""
