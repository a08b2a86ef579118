"""The reports: declarations over the roll-up operators."""
