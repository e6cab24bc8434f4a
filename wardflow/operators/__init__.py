"""DataFrame -> DataFrame operators.

Two rules hold throughout.  No frame that grows with the data is hinted for broadcast: the
hint is used only where the row count is bounded by construction (the docstring says by what),
and Catalyst/AQE decide the rest from measured sizes.  And no key's rows are ever gathered in
one task without having been reduced first.
"""
