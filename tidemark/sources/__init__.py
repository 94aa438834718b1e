"""Change logs in: bounded reads, streams, the composed front door, table facts."""
