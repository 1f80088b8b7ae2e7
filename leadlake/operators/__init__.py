"""DataFrame-in / DataFrame-out operators of the lakehouse layers."""
