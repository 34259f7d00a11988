from . import io, schemas

__all__ = ["io", "schemas"]
