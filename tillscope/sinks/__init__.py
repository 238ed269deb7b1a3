"""Writers and result shapes."""
