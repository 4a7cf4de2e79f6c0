"""Operations for large training-data collections."""
