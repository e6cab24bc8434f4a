"""Tables, measures and KPIs composed from the operators."""
