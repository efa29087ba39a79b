"""Table operators: diffs, pairings, tallies, rules and geometry as DataFrame plans."""
