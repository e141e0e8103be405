"""DataFrame-to-DataFrame operators; none of them reads or writes storage."""
