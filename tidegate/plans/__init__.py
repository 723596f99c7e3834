"""Plans: the pipeline, the message envelopes and the registered queries."""
