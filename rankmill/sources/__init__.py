"""Lake layout, schemas, page payloads: how data gets in and out."""
