"""Conformance checking of event logs against Petri nets, as Spark DataFrame plans."""
