"""Writers: message encoding, partitioned lake writes, staged table writes."""
