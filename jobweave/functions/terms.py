"""Vocabularies.  Everything here is a fixed value that results must match, in result order.

Blanks around a term are part of it.  Terms are matched without regard to case.
"""

# Fixed values.
FRAMEWORKS = [
    "Docker", "OSP", "Premiere", "directAdmin", "typography", "Prometheus", "visual weight",
    "Kubernetes", "JDBC", "UnitTest", "Servlets", "cPanel", "MySQL", ".NET", "Ruby on Rails", "JSP",
    "IdentityServer", "VoIP", "AdobeXD", "CMake", "Autocad", "Spring", "Django", "CRM", "K8S",
    "Nginx", "firmware", "Google Trend", "psd", "CSRF", "Reactjs", "Struts", "WebSocket", "Webpack",
    "Spine", "Vue", "METEOR", "Rancher", "VFX", "node js", "Angular", "Flask", "ASP.NET",
    "Google Analystics", "Zend", "Symfony", "Express", "Google Protobuf", "J2EE", "Ansible",
    "WebForm", "Videoscribe", "CakePHP", "Hibernate", "Git", "Oracle", "Plesk", "Log4j", "JSON",
    "Visio", "Grafana", "SDLC", " EELinux", " Redis", "Redux", "WinForm", "Figma", "CodeIgniter",
    "Power BI", "Bootstrap", "WPF", "Aerospike", "bash shell", "Laravel", "SQL Server",
]

# Fixed values.
DESIGN_PATTERNS = [
    "MVC", " Singleton", " WPF", " MVVM", "Session Facade", " DAO ", "OOA/OOD", "Factory Pattern",
    "Microservice",
]

# Fixed values.
KNOWLEDGE = [
    "game", "Jira", "lắp đặt", "interaction design", "đồ họa", "DevOps", " AI ", " async",
    "Quality Assurance", " Security ", "Google Drive", "NFT", "mạng máy tính", "Wordpress",
    "Machine Learning", "Consult", "White Box", "sale", "kiểm thử", "đánh giá chất lượng",
    "networking", "distributed system", "UI/UX", "Windows", "Unit Test", "Jenkins", "Chatbot",
    "quản trị mạng", "Solidity", "tester", "Corel Draw", "Illustrator", "Git", "Android",
    "phân tích dữ liệu", "Black Box", "Office", "chạy quảng cáo", "Unix", "IT Support",
    "Data mining", "data analys", "Cài đặt", "hệ điều hành", "cấu trúc dữ liệu", "Switch", " TCP",
    "qa", "Animate", "crypto", "CI/CD", "Defi", "frontend", "sửa chữa", "Kinh tế", "SVN",
    "phần cứng", " sync", "BrSE", "bảo mật", "Powerpoint", "smart contract", "Linux", "SCM",
    "backend", "Marketing", "XSS", "Photoshop", "HTTP", "Word", "router", "IOS", "WebSocket",
    "thuật toán", "TestRail", "CSDL", "Sketch", "blockchains", "multithreading", "hướng đối tượng",
    "Front-end", "latex", "Restful", "Subversion", "java web", "Mobile", "Excel", "design pattern",
]

# The category of a knowledge term.
KNOWLEDGE_LABELS = {
    "AI": "AI", "Machine Learning": "AI", "Data mining": "Data", "Chatbot": "AI",
    "data analys": "Data", "phân tích dữ liệu": "Data",
    "blockchains": "blockchain_crypto", "crypto": "blockchain_crypto", "NFT": "blockchain_crypto",
    "smart contract": "blockchain_crypto", "Solidity": "blockchain_crypto",
    "Defi": "blockchain_crypto", "XSS": "blockchain_crypto",
    "lắp đặt": "hardware", "sửa chữa": "hardware", "phần cứng": "hardware", "router": "hardware",
    "cài đặt": "hardware", "Corel Draw": "hardware", "Switch": "hardware",
    "Word": "office", "Excel": "office", "Powerpoint": "office", "Office": "office",
    "Illustrator": "photoshop", "Photoshop": "photoshop", "Animate": "photoshop",
    "cấu trúc dữ liệu": "programming_basic", "thuật toán": "programming_basic",
    "OOP": "programming_basic", "hướng đối tượng": "programming_basic",
    "hệ điều hành": "programming_basic", "multithreading": "programming_basic",
    "Black Box": "tester", "tester": "tester", "White Box": "tester", "Unit Test": "tester",
    "TestRail": "tester", "kiểm thử": "tester",
    "bảo mật": "security", "Security": "security",
    "SVN": "version_control", "SCM": "version_control", "Git": "version_control",
    "Front-end": "Web", "frontend": "Web", "backend": "Web", "java web": "Web",
    "mạng máy tính": "Mạng", "quản trị mạng": "Mạng",
}

# Terms listed under a category heading.
KNOWLEDGE_GROUPS = {
    "blockchain_crypto": ["blockchains", "crypto", "NFT", "smart contract", "Solidity", "Defi", "XSS"],
    "office": ["Word", "Excel", "Powerpoint", "Office"],
    "AI": [" AI", "Machine Learning", "Data mining", "Chatbot", "data analys"],
    "tester": ["Black Box", "tester", "White Box", "Unit Test", "TestRail", "kiểm thử"],
    "programming_basic": ["cấu trúc dữ liệu", "thuật toán", "OOP", "hướng đối tượng"],
    "version_control": ["SVN", "SCM", "Git"],
    "hard_ware": ["lắp đặt", "cài đặt", "sửa chữa", "phần cứng", "router", "Corel Draw", "Switch"],
    "photoshop": ["Illustrator", "Photoshop", "Animate"],
}

# Fixed values.
PROGRAMMING_LANGUAGES = [
    " CHAIN ", " ABAP ", "Lingo", " CPL", "NPL", "Xtend", " Flex ", " Io ", "Erlang", "Python",
    "MSL", "SAIL", " Chef ", "RPG", "PHP", "XPath", "Lava", " Clojure", "Mathematica", "QPL", "Oak",
    "Objective-C", "P#", "css", " Delphi", " A+ ", "XQuery", "CoffeeScript", " SR ", "ECMAScript",
    "Nial", " Red ", "Mesa", "LSL", "T-SQL", "E#", " GAP ", "Simula", "Logo", " Caml", "JavaScript",
    "PeopleCode", " UNITY ", " Blue ", "Span", "Lucid", " BeanShell", " CSP", "Scheme", "Swift",
    "TypeScript", " Scala ", "Scratch", "Strand", "XML", " SAS", "PortablE", "JADE", " C ",
    "Processing", "Pure", " BASIC ", " Bash", "Pro*C", "ROOP", "PL/SQL", "Icon", " Dart",
    " Factor ", "Java", "LINC", " Go ", " TIE ", " Cool", "Kotlin", "Rust", "Opa", "DYNAMO",
    " Inform ", "Mary", "Ruby", "YQL", "Pike", " rc ", " html ", "Oz", "Groovy", "PowerShell",
    " CUDA", "Hack", " Self ", " CFEngine", "C#", "SPS",
]

# A mention and the language it stands for.
LANGUAGES = {
    "Tiếng Anh": "Tiếng Anh",
    "Tiếng Nhật": "Tiếng Nhật",
    "Japan": "Tiếng Nhật",
    "English": "Tiếng Anh",
    "Tiếng Trung": "tiếng trung",
}

# Fixed values.
EDUCATION = [
    "Trung cấp", "Cao đẳng", "Cử nhân", "Kỹ sư", "Trung học phổ thông", "Thạc sĩ", "Tiến sĩ",
    "Chứng chỉ",
]

# The industry name that marks a posting as software or hardware.
JOB_TYPES = {"CNTT - Phần mềm": "software", "CNTT - Phần cứng / Mạng": "hardware"}

# Skills looked up as plain substrings, by topic.
SKILLS = [
    # programming languages
    "python", "java", "javascript", "typescript", "sql", "r", "scala", "go", "c++", "c#", "php",
    "ruby", "swift", "kotlin", "rust", "dart", "perl", "matlab", "sas", "stata",
    # data science
    "machine learning", "ml", "deep learning", "data science", "data analysis", "statistics",
    "analytics", "pandas", "numpy", "scipy", "scikit-learn", "sklearn", "tensorflow", "pytorch",
    "keras", "xgboost", "lightgbm", "catboost", "spark", "hadoop", "kafka", "elasticsearch",
    # reporting
    "tableau", "power bi", "excel", "spss", "matplotlib", "seaborn", "plotly", "d3.js", "looker",
    "qlik", "microstrategy", "cognos",
    # cloud and operations
    "aws", "amazon web services", "azure", "gcp", "google cloud", "docker", "kubernetes", "jenkins",
    "git", "github", "gitlab", "bitbucket", "ci/cd", "terraform", "ansible",
    # databases
    "mysql", "postgresql", "postgres", "mongodb", "redis", "cassandra", "oracle", "sql server",
    "sqlite", "dynamodb", "bigquery", "redshift",
    # web
    "html", "css", "react", "angular", "vue", "node.js", "express", "django", "flask", "spring",
    "laravel", "rails", "fastapi", "streamlit", "dash",
    # ways of working
    "agile", "scrum", "jira", "confluence", "project management", "leadership", "communication",
    "teamwork", "problem solving", "critical thinking",
    # domains
    "finance", "banking", "healthcare", "e-commerce", "retail", "manufacturing",
    "telecommunications", "automotive", "aerospace", "energy", "pharmaceuticals",
]
