"""DataFrame operators: column contract, write options, placement, load, merge, reports."""
