"""File arrivals as a stream."""
