"""Small word lists used by rule-based extraction; all are parameters.

They are ours, as are the thresholds: the fields they fill have no rule of
their own beyond the record contract.
"""

from __future__ import annotations

TECHNICAL = (
    "airflow", "aws", "azure", "c#", "c++", "django", "docker", "fastapi", "flask",
    "gcp", "git", "java", "javascript", "kafka", "kubernetes", "linux", "mongodb",
    "postgresql", "power bi", "python", "react", "redis", "spark", "sql", "terraform",
)
SOFT = (
    "adaptabilidad", "comunicación", "empatía", "liderazgo", "negociación",
    "proactividad", "trabajo en equipo",
)
INDUSTRIES = (
    "banca", "enseñanza", "fintech", "logística", "minería", "retail", "salud", "seguros",
)
CERTIFICATES = ("aws certified", "cisa", "cpa", "itil", "pmp", "scrum master")

TERMS: dict[str, str] = {
    **{t: "tecnico" for t in TECHNICAL},
    **{t: "blando" for t in SOFT},
    **{t: "industria" for t in INDUSTRIES},
    **{t: "certificacion" for t in CERTIFICATES},
}

# Word -> degree; degrees rank in the order of contract.DEGREES.
DEGREE_WORDS: dict[str, str] = {
    "técnico": "tecnico",
    "técnica": "tecnico",
    "bachiller": "bachiller",
    "ingeniería": "bachiller",
    "licenciado": "licenciado",
    "licenciada": "licenciado",
    "licenciatura": "licenciado",
    "titulado": "licenciado",
    "maestría": "magister",
    "magíster": "magister",
    "máster": "magister",
    "doctor": "doctor",
    "doctora": "doctor",
    "doctorado": "doctor",
}

# Languages recognised where no "name: level" pair is written.
LANGUAGES = ("alemán", "español", "francés", "inglés", "italiano", "portugués", "quechua")

# Headings that open each part of a document.
SECTIONS: dict[str, tuple[str, ...]] = {
    "profile": ("PERFIL PROFESIONAL", "PERFIL", "RESUMEN"),
    "experience": ("EXPERIENCIA LABORAL", "EXPERIENCIA PROFESIONAL", "EXPERIENCIA"),
    "education": ("EDUCACIÓN", "FORMACIÓN", "FORMACIÓN ACADÉMICA"),
    "languages": ("IDIOMAS",),
    "mandatory": ("REQUISITOS OBLIGATORIOS", "REQUISITOS"),
    "desirable": ("REQUISITOS DESEABLES", "DESEABLES"),
    "role": ("FUNCIONES", "DESCRIPCIÓN DEL PUESTO"),
    # They fill no field but end the one before.
    "other": ("HABILIDADES", "HABILIDADES TÉCNICAS", "COMPETENCIAS", "CERTIFICACIONES", "CURSOS", "REFERENCIAS", "DATOS PERSONALES", "CONTACTO", "OFRECEMOS", "BENEFICIOS"),
}

# Years below each bound give the level.
LEVEL_BOUNDS: tuple[tuple[float, str], ...] = ((2, "junior"), (5, "semi-senior"), (10, "senior"))
TOP_LEVEL = "lead"

NO_DEGREE = "no especificado"
