"""The stateless part of the plan on streams, and upserts of their batches."""
