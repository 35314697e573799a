"""DataFrame operators: the movement model, snapshot, rollup, ordered lag, dimension joins."""
